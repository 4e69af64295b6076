"""Connected groups of rows from shared tokens and verified links, without pairs inside a group."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.scratch import discard, materialize

#: Verifying a candidate costs as much as meeting so many rows of lists.
VERIFY_COST = 20
#: Ids that ask in one task of ``met_pairs``, rows of lists that it holds, and counters or rows it fills at a time.
ASKING, MET_ROWS, COUNTERS = 512, 1_000_000, 4_000_000


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _to_smallest(edges: DataFrame) -> DataFrame:
    """Edges (u > v) after every larger neighbour of a node, then every node and its smaller ones, moved to the smallest."""
    either = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = either.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    larger = either.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = larger.groupBy("u").agg(F.min("v").alias("m"))
    moved = larger.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(id, root) of every node of ``edges`` (a, b: long); root is the smallest id that links lead to.

    Repeats ``_to_smallest`` until nothing changes.  Minima combine before the shuffle and stars are the end, so a node
    with many neighbours is never gathered.
    """
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current, before = materialize(_to_smallest(both), "edges"), None
    state = _state(current)
    while state != before:
        last, current = current, materialize(_to_smallest(current), "edges")
        discard(last)
        before, state = state, _state(current)
    stars = current.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("id"), "root").distinct())


def _open(own: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Postings with ``root``, ``df`` and ``lists`` (how many each id stands in) that may still lead to another group.

    Ids of different groups share at least their ``need`` of tokens, and every list that holds both is a list of several
    groups.  So other lists go, and then ids that stand in fewer than ``need`` of the rest.
    """
    if groups is not None or "df" not in own.columns:
        own = own.drop("root", "df", "lists", "weight")
        own = own.withColumn("root", F.col("id")) if groups is None else own.join(groups, "id", "left").withColumn("root", F.coalesce("root", "id"))
        lists = own.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("df")).where("low < high")
        own = own.join(lists.select("token", "df"), "token")
    enough = own.groupBy("id").agg(
        F.count(F.lit(1)).alias("lists"), F.first("need").alias("least"), (F.sum("df") / F.first("size")).alias("weight")
    ).where("lists >= least")
    return materialize(own.join(enough.select("id", "lists", "weight"), "id"), "open")


def _lightened(own: DataFrame) -> DataFrame:
    """Postings without the longest lists of each id, as many of its ``spare`` ones as make its estimated cost least; ``left_out`` counts them.

    ``longest`` is the token of each id's longest list, whether left out or not.
    With R rows met in the lists that stay and l shared tokens still asked for, at most R / l ids are candidates; each
    costs as much as VERIFY_COST rows.
    """
    heaviest = Window.partitionBy("id").orderBy(F.desc("df"), "token")  # one id's tokens
    ranked = own.withColumn("rank", F.row_number().over(heaviest)).withColumn("met", F.sum(F.col("df") - 1).over(heaviest))
    ranked = ranked.withColumn("longest", F.first("token").over(heaviest))
    totals = own.groupBy("id").agg(F.sum(F.col("df") - 1).alias("total"))
    cost = (F.col("total") - F.col("met")) * (1 + F.lit(VERIFY_COST) / (F.col("need") - F.col("rank")))
    choices = ranked.where("rank <= spare").join(totals, "id").groupBy("id").agg(
        F.min(F.struct(cost.alias("cost"), F.col("rank"))).alias("best"),
        F.first(F.col("total") * (1 + F.lit(VERIFY_COST) / F.col("need"))).alias("all"),
    )
    chosen = choices.select("id", F.when(F.col("best.cost") < F.col("all"), F.col("best.rank")).otherwise(0).cast("long").alias("left_out"))
    out = ranked.join(chosen, "id", "left").withColumn("left_out", F.coalesce("left_out", F.lit(0).cast("long")))
    return materialize(out.where("rank > left_out").drop("rank", "met"), "lightened")


def met_pairs(light: DataFrame, ratio: tuple[int, int], overlap: tuple[int, int]) -> DataFrame:
    """Pairs (a < b) of different groups that may be linked, from the postings of ``_lightened``; see ``linked_groups``.

    Ids ask for the others in their lists, of two groups only the one with fewer postings (then the smaller root), so a large
    group is met and does not ask.  Those with one longest list ask together, ASKING at most, so ids of one family share the lists
    they look at, and a list is written once for each such company instead of once a pair.  What a company meets is dealt out
    by id to parts of about MET_ROWS rows; a task counts the shared tokens of its pairs and gives back only pairs with as
    many as a link needs.
    """
    keys, facts = ["cluster", "piece"], ["token", "id", "root", "bulk", "size", "need", "lists", "left_out"]
    standing = F.struct("bulk", "root")
    light = materialize(light.join(light.groupBy("root").agg(F.count(F.lit(1)).alias("bulk")), "root").select(*facts, "longest"), "standing")
    lists = light.groupBy("token").agg(F.count(F.lit(1)).alias("length"), F.max(standing).alias("most"))
    asking = light.join(lists.where("length > 1"), "token").where(standing < F.col("most")).select(*facts, "longest", "length")
    home = asking.groupBy("id").agg(F.first("longest").alias("cluster"))
    wide = home.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / ASKING).cast("int").alias("pieces"))
    home = home.join(wide, "cluster").select("id", "cluster", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int").alias("piece"))
    asking = materialize(asking.join(home, "id").select(*facts, "length", *keys), "asking")
    tokens = asking.groupBy(*keys, "token").agg(F.first("length").alias("length"))
    parts = tokens.groupBy(*keys).agg(F.ceil(F.sum("length") / MET_ROWS).cast("int").alias("parts"))
    parts = materialize(parts, "companies")
    met = tokens.join(light.select(*facts), "token").join(parts, keys).select(
        *keys, F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), *facts, F.lit(False).alias("asks")
    )
    asked = asking.join(parts, keys).select(*keys, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), *facts, F.lit(True).alias("asks"))

    def counted(table: pa.Table) -> pa.Table:
        token, name, root, bulk, size, need, lists, left, asks = (table.column(c).to_numpy() for c in [*facts, "asks"])
        by_id = np.unique(name, return_index=True)[1]
        name_of, size_of, need_of, lists_of, left_of = (x[by_id] for x in (name, size, need, lists, left))
        standing_of = np.unique(np.column_stack([bulk[by_id], root[by_id]]), axis=0, return_inverse=True)[1].ravel()
        number = np.searchsorted(name_of, name)
        others = np.flatnonzero(~asks)
        others = others[np.argsort(token[others], kind="stable")]
        rows = np.flatnonzero(asks)
        rows = rows[np.argsort(number[rows], kind="stable")]
        begin, end = (np.searchsorted(token[others], token[rows], side=s) for s in ("left", "right"))
        met_number = number[others]
        first = np.append(np.flatnonzero(np.diff(number[rows], prepend=-1)), len(rows))
        total, ones, twos = np.concatenate([[0], np.cumsum(end - begin)]), [], []
        at, most_ids = 0, max(1, COUNTERS // len(name_of))
        while at < len(first) - 1:
            # whole ids: as many as the counters and rows allow, one at least
            to = int(np.searchsorted(total[first], total[first[at]] + COUNTERS, side="right")) - 1
            to = min(max(to, at + 1), at + most_ids, len(first) - 1)
            low, high = first[at], first[to]
            lengths = end[low:high] - begin[low:high]
            places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths - begin[low:high], lengths)
            asker = np.repeat(np.repeat(np.arange(to - at), np.diff(first[at : to + 1])), lengths)
            counts = np.bincount(asker * len(name_of) + met_number[places], minlength=(to - at) * len(name_of))
            found = np.flatnonzero(counts)
            shared, one, two = counts[found], number[rows[first[at + found // len(name_of)]]], found % len(name_of)
            sizes = size_of[one] + size_of[two]
            good = standing_of[one] < standing_of[two]
            good &= np.minimum(size_of[one], size_of[two]) * ratio[1] >= np.maximum(size_of[one], size_of[two]) * ratio[0]
            good &= np.minimum(lists_of[one], lists_of[two]) * overlap[1] >= sizes * overlap[0]
            least = np.maximum(np.maximum(need_of[one], need_of[two]), -(-sizes * overlap[0] // overlap[1]))
            good &= shared >= least - np.maximum(left_of[one], left_of[two])
            ones.append(np.minimum(name_of[one[good]], name_of[two[good]]))
            twos.append(np.maximum(name_of[one[good]], name_of[two[good]]))
            at = to
        return pa.table({"a": np.concatenate(ones or [np.zeros(0, np.int64)]), "b": np.concatenate(twos or [np.zeros(0, np.int64)])})

    return met.unionByName(asked).groupBy(*keys, "part").applyInArrow(counted, "a long, b long")


def _near(left: dict, right: dict, ratio: tuple[int, int], close, overlap) -> Column:
    near = F.least(left["size"], right["size"]) * ratio[1] >= F.greatest(left["size"], right["size"]) * ratio[0]
    if overlap:
        near = near & (F.least(left["lists"], right["lists"]) * overlap[1] >= (left["size"] + right["size"]) * overlap[0])
    return near & close(left["mark"], right["mark"]) if close else near


def _tried(own: DataFrame, number: int, verify: Callable[[DataFrame], DataFrame], ratio: tuple[int, int], close=None, overlap=None) -> DataFrame:
    """Links that are found if every id tries the one it meets most often outside its group, when each list shows one id.

    In the first round that is the id that stands in the longest lists for its size, the middle of a group of copies, so most
    copies are settled by it; later rounds show others.
    """
    turn = F.xxhash64("id", F.lit(number)) if number else F.col("weight")
    shown = ["id", "size", "root", "lists"] + (["mark"] if close else [])
    first = own.groupBy("token").agg(F.max(F.struct(turn.alias("turn"), *shown)).alias("first"))
    sides = {c: F.col(c) for c in shown}, {c: F.col(f"first.{c}") for c in shown}
    met = own.join(first, "token").where((F.col("root") != F.col("first.root")) & _near(*sides, ratio, close, overlap))
    met = met.groupBy("id", F.col("first.id").alias("other")).agg(F.count(F.lit(1)).alias("times"))
    best = met.groupBy("id").agg(F.max(F.struct("times", "other")).alias("best"))
    pairs = materialize(best.select(F.least("id", "best.other").alias("a"), F.greatest("id", "best.other").alias("b")).distinct(), "pairs")
    found = materialize(verify(pairs), "links")
    discard(pairs)
    return found


def first_links(postings: DataFrame, verify: Callable[[DataFrame], DataFrame], ratio: tuple[int, int]) -> DataFrame:
    """Some links (a, b), a verified pair an id at most, from any part of the postings (token, id, size); they settle most copies."""
    own = _open(postings.select("token", "id", F.lit(1).cast("long").alias("need"), "size"), None)
    found = _tried(own, 0, verify, ratio)
    discard(own)
    return found


def linked_groups(postings: DataFrame, verify: Callable[[DataFrame], DataFrame], ratio: tuple[int, int], rounds: int = 3,
                  close: Callable[[Column, Column], Column] | None = None, overlap: tuple[int, int] | None = None,
                  links: DataFrame | None = None, groups: DataFrame | None = None, spent: bool = False) -> DataFrame:
    """(id, root) of all ids with a link, from ``postings`` (token, id, need, size, and maybe spare and mark: all long).

    Ids may be linked only if both share at least their ``need`` of tokens, the smaller size is at least ratio[0] / ratio[1]
    of the larger, their marks are ``close``, and, with ``overlap``, they share that part of the sum of their sizes, which
    neither can if it stands in fewer lists; ``spare`` is less than ``need``.  ``verify`` takes pairs (a < b) and returns
    those that are linked.  ``links`` (a, b) are links known before, ``groups`` what they connect, if that is known too; the
    postings of ids that they settle may be missing.  Postings may have their groups by these links, ``root``, and the numbers
    of ids of their lists, ``df``, already.  ``spent``: nothing else reads the written ``postings``, which go when they are read.

    Rounds: in every token's list the ids meet one id of it, another one each round, and each id tries the one it meets
    most often outside its group; what is verified joins groups.  That takes a pair an id and round and settles groups of copies.  At last
    every pair of ids that could be linked but stand in different groups is verified, so no link between groups is missed:
    each id leaves out some of its longest lists (``_lightened``); the shortest list that holds two linked ids is left out by
    neither, as ``need - 1`` other shared ones are longer.  What is missing of two ids' shared tokens is the longer of two
    beginnings in one order of lists, so at most the larger number left out.  With ``overlap`` and ``spare`` these pairs are
    counted in companies of ids (``met_pairs``), else by a join of the lists.
    """
    groups = connected(links) if groups is None and links is not None else groups
    own = _open(postings, None if "df" in postings.columns else groups)
    links = own.sparkSession.createDataFrame([], "a long, b long") if links is None else links
    if spent:
        discard(postings)

    for number in range(rounds):
        found = _tried(own, number, verify, ratio, close, overlap)
        if found.isEmpty():
            break
        links = links.unionByName(found)
        groups = connected(links)
        last, own = own, _open(own, groups)
        discard(last)

    if overlap and "spare" in own.columns:
        light = _lightened(own)
        could = met_pairs(light, ratio, overlap)
    else:
        light = own
        columns = ["id", "root", "need", "size", "lists"] + (["mark"] if close else [])
        left, right = (own.select("token", *(F.col(c).alias(f"{c}_{side}") for c in columns)) for side in "ab")
        sides = ({c: F.col(f"{c}_{side}") for c in columns} for side in "ab")
        could = left.join(right, "token").where((F.col("id_a") < F.col("id_b")) & (F.col("root_a") != F.col("root_b")) & _near(*sides, ratio, close, overlap))
        least = F.min(F.greatest("need_a", "need_b")).alias("least")
        could = could.groupBy(F.col("id_a").alias("a"), F.col("id_b").alias("b")).agg(F.count(F.lit(1)).alias("shared"), least).where("shared >= least")
    pairs = materialize(could.select("a", "b"), "pairs")
    found = materialize(verify(pairs), "links")
    if not found.isEmpty():
        groups = connected(links.unionByName(found))
    discard(own, pairs, *([] if light is own else [light]))
    return groups if groups is not None else own.sparkSession.createDataFrame([], "id long, root long")


def with_payload(pairs: DataFrame, payload: DataFrame, most: int = 2_000) -> DataFrame:
    """``pairs`` (a, b) with the payload of both sides as ``pa`` and ``pb``; ``payload`` is (id, value), one row an id.

    An id that stands in many pairs is dealt out: its payload is repeated once for every ``most`` of them.
    """
    out = pairs
    for side in ("a", "b"):
        degree = pairs.groupBy(side).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("parts"))
        dealt = payload.join(degree, F.col("id") == F.col(side)).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        dealt = dealt.select(F.col("id").alias(side), "part", "parts", F.col("value").alias(f"p{side}"))
        other = "b" if side == "a" else "a"
        out = out.join(degree, side).withColumn("part", F.pmod(F.xxhash64(other), F.col("parts")).cast("int")).drop("parts")
        out = out.join(dealt.drop("parts"), [side, "part"]).drop("part")
    return out
