"""N-gram Jaccard join by adaptive multi-match prefixes.

A document is the set of hashes of its distinct five-word shingles; two are linked when
their Jaccard similarity reaches 75 / 100.  In the order of the hashes, two sets that
overlap in at least t members share at least l members among their first size - t + l
ones.  A document offers such a prefix, t = ceil(0.75 size) and l = size / 4 + 1, and

* documents that share fewer than l tokens with all others together have no candidate
  and drop out before any pair is made;
* in the lists of an eighth of the tokens each document meets the one in the middle of its
  copies and is verified against it, which settles most groups of copies; documents that
  share fewer than l tokens with documents of other groups drop out then;
* those left have candidates: their prefixes are lengthened to the whole set, which asks
  for ceil(0.75 size) shared tokens, and documents drop out again, also after every round
  of links;
* a set may leave out its longest lists, fewer than any linked set shares with it: how
  many is chosen for each document by the estimated cost, rows met plus candidates to
  verify, and a candidate needs as many shared tokens as are left of those asked for;
* a pair shares 3 / 7 of the sum of its sizes, so sets that stand in fewer lists are no pair.

Equal sets are one class; links are looked for between classes and settle groups as
``components.linked_groups`` says, so a group of copies costs one pair a member.

Words are runs without the bytes 32 and 9 to 13, A-Z lower-cased; hashes have 64 bits
(classes are told apart by 64 bits of the whole set, members by 48 when verified, tokens of prefixes by 40:
members of one set that agree in those count once).

Defined results: null, empty and blank texts have no set and stand alone; texts of
fewer than five words are one shingle; rows that share an id are documents of their
own; the component of a group without any id is null; an empty table gives no row;
extra columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import broadcast_below, chunks, mix, pick, raw_bytes, restored, row_key, with_number
from gristmill.llm.components import connected, first_links, linked_groups, with_payload
from gristmill.llm.token_lists import BUCKET_TOKENS, PACKED, SHARED, TOKEN_BITS, known_tokens, packed, shared_tokens, spread
from gristmill.llm.words import shingle_sets
from gristmill.scratch import discard, materialize

#: Similarity of at least NUMERATOR / DENOMINATOR.
NUMERATOR, DENOMINATOR = 75, 100
#: Prolongation of a prefix, as a share of the set.
SLACK = 0.25
#: Leading bytes of each hash by which sets are verified.
MEMBER_BYTES = 6
CHUNK = 1 << 18
BROADCAST_ROWS = 1_000_000
#: Part of the tokens that the first links are looked for in (all tokens of sets smaller than SMALL); all others come in later.
PART, SMALL = 8, 64
#: Rounds of ``linked_groups`` after that.
ROUNDS = 1


def set_key(members: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    total = np.add.reduce(mix(members)) + np.uint64(len(members))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def sets_column(text: Column) -> Column:
    """Struct (n, key) of each whole text: members of its shingle set and the set's name (null where there is none)."""

    @F.arrow_udf("n long, key long")
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            sizes, keys = [], []
            for chunk in chunks(raw_bytes(values), CHUNK):
                for members in shingle_sets(chunk):
                    sizes.append(len(members))
                    keys.append(set_key(members) if len(members) else None)
            yield pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(keys, pa.int64())], names=["n", "key"])

    return measured(text)


def prefix_length(n: int) -> int:
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


def _offered(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Packed tokens of longest prefixes; a set that the task has met already is left out, so copies cost one entry a task."""
    seen: set[int] = set()
    for batch in batches:
        for chunk in chunks(raw_bytes(batch.column("text")), 32 * CHUNK):
            keys, sizes, tokens, own, place = [], [], [], [], []
            for part in chunks(iter(chunk), CHUNK):
                for members in shingle_sets(part):
                    if not len(members) or (key := set_key(members)) in seen:
                        continue
                    seen.add(key)
                    n = len(members)
                    taken = members[: prefix_length(n) + int(SLACK * n)] >> np.uint64(64 - TOKEN_BITS)
                    tokens.append(taken)
                    own.append(np.full(len(taken), len(keys), np.uint32))
                    place.append(np.arange(len(taken), dtype=np.uint32))
                    keys.append(key)
                    sizes.append(n)
            if not keys:
                continue
            yield from spread(np.concatenate(tokens), np.concatenate(own), np.concatenate(place), keys, sizes, buckets)


def survivors(shared: DataFrame) -> DataFrame:
    """Ids that share at least ``least_shared`` tokens of their prefix with others."""
    lists = shared.groupBy("id").agg(F.count(F.lit(1)).alias("lists"), F.first("size").alias("n"))
    return lists.where(F.col("lists") >= least_shared(F.col("n"))).select("id")


def still_open(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """Ids that share at least ``least_shared`` tokens of their prefix with ids of other groups, so may have more links."""
    own = shared.join(groups.select("id", "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    several = own.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return survivors(own.join(several.select("token"), "token"))


def numbered(ids: DataFrame, groups: DataFrame) -> DataFrame:
    """(id, top, number, root): the group of each of ``ids``, short numbers, and the least number of each one's group."""
    own = ids.join(groups.select("id", "root"), "id", "left").select("id", F.coalesce("root", "id").alias("top"))
    own = materialize(own.withColumn("number", F.monotonically_increasing_id()), "numbers")
    least = own.groupBy("top").agg(F.min("number").alias("root"))
    return materialize(own.join(least, "top").select("id", "top", "number", "root"), "still-open")


def whole_postings(members: DataFrame) -> DataFrame:
    """(token, id, need, spare, size, root, df) of whole sets, from (id, value, root): tokens that several groups have, and how many ids."""
    total = members.agg(F.sum(F.length("value"))).first()[0] or 0
    buckets = max(1, math.ceil(total / MEMBER_BYTES / BUCKET_TOKENS))

    def offered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("id").to_pylist(), batch.column("root").to_pylist(), raw_bytes(batch.column("value")))
            for part in chunks((Named(raw, (name, root)) for name, root, raw in rows), 32 * CHUNK):
                sets = [_members(raw) >> np.uint64(64 - TOKEN_BITS) for raw in part]
                own = np.repeat(np.arange(len(sets), dtype=np.uint32), [len(s) for s in sets])
                facts = [(len(s), raw.name[1]) for s, raw in zip(sets, part)]
                yield from packed(np.concatenate(sets), own, np.zeros(len(own), np.uint32), [raw.name[0] for raw in part], facts, buckets)

    shared = members.mapInArrow(offered, PACKED).groupBy("bucket").applyInArrow(open_tokens, "token long, id long, size long, root long, df long")

    def needed(size: Column) -> Column:
        return F.ceil(size * NUMERATOR / F.lit(DENOMINATOR))

    return shared.select("token", "id", needed(F.col("size")).alias("need"), (needed(F.col("size")) - 1).alias("spare"), "size", "root", "df")


def open_tokens(key, table):
    """``shared_tokens`` that ids of several groups have, with the groups and the number of ids; ``sizes`` holds (size, root)."""
    facts = [np.frombuffer(raw, np.int64).reshape(-1, 2) for raw in table.column("sizes").to_pylist()]
    begins = np.cumsum([0] + [len(f) for f in facts])
    rows = pa.array([np.arange(a, b).tobytes() for a, b in zip(begins[:-1], begins[1:])], pa.binary())
    shared = shared_tokens(key, table.set_column(table.schema.get_field_index("sizes"), "sizes", rows))
    token, name, row = (shared.column(c).to_numpy() for c in ("token", "id", "size"))
    size, root = np.concatenate(facts)[row].T
    begin = np.flatnonzero(np.diff(token, prepend=~token[:1]))
    counts = np.diff(np.append(begin, len(token)))
    several = np.minimum.reduceat(root, begin) < np.maximum.reduceat(root, begin) if len(begin) else np.zeros(0, bool)
    stays, df = np.repeat(several, counts), np.repeat(counts, counts)
    return pa.table({"token": token[stays], "id": name[stays], "size": size[stays], "root": root[stays], "df": df[stays]})


class Named(bytes):
    """Bytes with the id and the group they belong to."""

    def __new__(cls, raw: bytes, name: tuple):
        own = super().__new__(cls, raw)
        own.name = name
        return own


def least_shared(size: Column) -> Column:
    """Tokens that a set of this size shares at least, prefix with prefix, with every set it is linked to.

    Let a be the larger set, b the smaller, t(n) = ceil(0.75 n), and prefixes n - t(n) + floor(n / 4) + 1 long.  They overlap
    in t(a) members at least, so the prefixes share floor(a / 4) + 1, or floor(b / 4) + 1 + t(a) - t(b) if that is less: it is,
    by one, where 4 divides a and b = a - 1.
    """
    return F.floor((size - 1) * F.lit(SLACK)) + 1


def members_column(text: Column) -> Column:
    """The shingle set of each whole text: sorted, MEMBER_BYTES leading bytes of each hash."""

    @F.arrow_udf("binary")
    def packed_sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            out = []
            for chunk in chunks(raw_bytes(values), CHUNK):
                for members in shingle_sets(chunk):
                    out.append(members.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :MEMBER_BYTES].tobytes())
            yield pa.array(out, pa.binary())

    return packed_sets(text)


def _members(raw: bytes) -> np.ndarray:
    full = np.zeros((len(raw) // MEMBER_BYTES, 8), np.uint8)
    full[:, :MEMBER_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, MEMBER_BYTES)
    return full.view(">u8").ravel().astype(np.uint64)


def similar_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs (a, b) of set names whose sets are similar enough; ``members`` is (id, value) with each packed set."""

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, known = [], {}
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            for i, (x, y, packed_x, packed_y) in enumerate(zip(a, b, raw_bytes(batch.column("pa")), raw_bytes(batch.column("pb")))):
                if len(known) > 256:
                    known.clear()
                for name, raw in ((x, packed_x), (y, packed_y)):
                    if name not in known:
                        known[name] = _members(raw)
                one, other = known[x], known[y]
                common = len(np.intersect1d(one, other, assume_unique=True))
                if DENOMINATOR * common >= NUMERATOR * (len(one) + len(other) - common):
                    good.append(i)
            at = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])

    return with_payload(pairs, members).select("a", "b", "pa", "pb").mapInArrow(checked, "a long, b long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id that links lead to), ``row`` (hash of id and text), ``root``.

    ``root`` names the component (a class of it; null for documents without a set).
    """
    own = pick(docs, id_column, text_column).select(F.col(id_column).alias("doc"), F.col(text_column).alias("text"))
    row = row_key(F.col("doc"), F.col("text"))
    sets = materialize(own.select("doc", row.alias("row"), sets_column(F.col("text")).alias("s")).select("doc", "row", "s.*"), "sets")
    total = sets.agg(F.sum(F.floor(F.col("n") * (1 - NUMERATOR / DENOMINATOR + SLACK)) + 1)).first()[0] or 0
    buckets = max(1, math.ceil(total / BUCKET_TOKENS))
    offered = own.select("text").mapInArrow(lambda b: _offered(b, buckets), PACKED)
    shared = materialize(offered.groupBy("bucket").applyInArrow(lambda key, table: known_tokens(key, table, buckets), SHARED).drop("place"), "shared")
    alive = materialize(survivors(shared), "alive")
    classes = sets.where("key IS NOT NULL").groupBy("key").agg(F.min(F.struct("doc", "row")).alias("first"), F.min("doc").alias("doc"))
    wanted = alive.join(classes, F.col("id") == F.col("key")).select("id", F.col("first.row").alias("row"))
    wanted = materialize(wanted, "wanted")
    texts = own.withColumn("row", row).join(broadcast_below(wanted, BROADCAST_ROWS), "row").dropDuplicates(["id"])
    members = materialize(texts.select("id", members_column(F.col("text")).alias("value")), "members")
    small, ratio = (F.col("token") % PART == 0) | (F.col("size") < SMALL), (NUMERATOR, DENOMINATOR)
    links = first_links(shared.where(small), lambda pairs: similar_pairs(pairs, members), ratio)
    groups = connected(links)
    left = numbered(still_open(shared, groups), groups)
    of_left = materialize(members.join(left.select("id", "number", "root"), "id").select(F.col("number").alias("id"), "value", "root"), "open-members")
    discard(shared, alive, wanted, members)
    postings = materialize(whole_postings(of_left), "whole-sets")
    known = left.where("number <> root").select(F.col("number").alias("a"), F.col("root").alias("b"))
    stars = known.select(F.col("a").alias("id"), F.col("b").alias("root"))
    stars = stars.unionByName(stars.select(F.col("root").alias("id"), "root").distinct())
    overlap = (NUMERATOR, NUMERATOR + DENOMINATOR)
    more = linked_groups(postings, lambda pairs: similar_pairs(pairs, of_left.select("id", "value")), ratio, ROUNDS, overlap=overlap, links=known, groups=stars)
    discard(postings, of_left)
    # groups that later links join: all take the smallest name of theirs
    joined = left.select("top", F.col("number").alias("id")).join(more.withColumnRenamed("root", "joint"), "id").select("top", "joint").distinct()
    moved = joined.join(joined.groupBy("joint").agg(F.min("top").alias("least")), "joint").where("top <> least").select("top", "least")
    rooted = classes.join(groups, F.col("key") == F.col("id"), "left").select("key", "doc", F.coalesce("root", "key").alias("root"))
    rooted = rooted.join(moved, F.col("root") == F.col("top"), "left").select("key", "doc", F.coalesce("least", "root").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("doc").alias("component"))
    named = rooted.join(smallest, "root").select("key", "component", "root")
    alone = sets.where("key IS NULL").select("doc", "row", "n", F.col("doc").alias("component"), F.lit(None).cast("long").alias("root"))
    out = sets.where("key IS NOT NULL").join(named, "key").select("doc", "row", "n", "component", "root").unionByName(alone)
    return out.select(F.col("doc").alias(id_column), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "row", "root")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id (then hash of id and text) of every component, and all without a set; equal rows once."""
    found = materialize(near_duplicates(docs, id_column, text_column), "components")
    first = found.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct(F.col(id_column).alias("doc"), "row")).alias("first"))
    staying = first.select(F.col("first.row").alias("__row")).unionByName(found.where("root IS NULL").select(F.col("row").alias("__row")))
    copies = found.groupBy(F.col("row").alias("__row")).agg(F.count(F.lit(1)).alias("__copies"))
    staying = materialize(staying.distinct().join(copies, "__row"), "staying")
    plain = with_number(docs, (id_column, text_column), lambda c: {"__key": row_key(c[id_column], c[text_column])})
    kept = plain.join(broadcast_below(staying, BROADCAST_ROWS), F.col("__key") == F.col("__row"))
    once = kept.where("__copies = 1").unionByName(kept.where("__copies > 1").dropDuplicates(["__key"]))
    return restored(once, docs)
