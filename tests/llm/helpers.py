"""Plain versions of what the operators do, for small tables."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def near_copies(seed, families=6, members=6, words=60, edits=2):
    """Texts in families: random words, each member with a few of them changed."""
    rng = random.Random(seed)
    out = []
    for _ in range(families):
        base = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(words)]
        for _ in range(members):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(words)] = "".join(rng.choice("xyz") for _ in range(4))
            out.append(" ".join(own))
    rng.shuffle(out)
    return out


class Groups:
    """Union of numbered things; the smallest number names a group."""

    def __init__(self):
        self.above = {}

    def find(self, x):
        while self.above.setdefault(x, x) != x:
            x = self.above[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.above[max(a, b)] = min(a, b)


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def jaccard_components(rows):
    """doc_id -> (shingles, component) by comparing all pairs."""
    sets = {d: shingles(t) for d, t in rows}
    groups, own = Groups(), sorted(sets)
    for i, a in enumerate(own):
        for b in own[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                groups.join(a, b)
    return {d: (len(sets[d]), groups.find(d)) for d in own}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def within(a, b, most):
    """Is the edit distance at most ``most``?  A column of the table at a time, its differences held in the bits of two numbers."""
    if not a or not b:
        return max(len(a), len(b)) <= most
    full, last, at = (1 << len(a)) - 1, 1 << (len(a) - 1), {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    up, down, distance = full, 0, len(a)
    for y in b:
        same = at.get(y, 0)
        across = (((same & up) + up) ^ up) | same
        right, left = down | (full & ~(across | up)), up & across
        distance += bool(right & last) - bool(left & last)
        right, left = (right << 1 | 1) & full, (left << 1) & full
        up, down = left | (full & ~(same | down | right)), right & (same | down)
    return distance <= most


def lines_kept(rows):
    """doc_id -> kept lines, by comparing all pairs of different normal forms.

    An edit changes the count of at most two characters by one, so forms whose counts differ by more need no look.
    """
    import numpy as np

    seen = {}
    for d, text in sorted(rows):
        for n, line in enumerate((text or "").split("\n")):
            form = b" ".join(line.encode().lower().split()).decode()
            if form:
                seen.setdefault(form, []).append((d, n))
    groups, forms = Groups(), list(seen)
    letters = sorted({c for form in forms for c in form})
    at = {c: k for k, c in enumerate(letters)}
    counts = np.zeros((len(forms), len(letters)), np.int32)
    for i, form in enumerate(forms):
        np.add.at(counts[i], [at[c] for c in form], 1)
    sizes = np.array([len(form) for form in forms])
    for i, a in enumerate(forms):
        most = np.maximum(sizes[:i], len(a)) // 10
        near = np.flatnonzero(np.abs(sizes[:i] - len(a)) <= most)
        apart = counts[near] - counts[i]
        near = near[(np.clip(apart, 0, None).sum(axis=1) <= most[near]) & (np.clip(-apart, 0, None).sum(axis=1) <= most[near])]
        for j in near.tolist():
            if groups.find(i) != groups.find(j) and within(a, forms[j], int(most[j])):
                groups.join(i, j)
    first = {}
    for i, form in enumerate(forms):
        root = groups.find(i)
        first[root] = min(first.get(root, seen[form][0]), *seen[form])
    stays = {first[groups.find(i)] for i in range(len(forms))}
    gone = {at for form in forms for at in seen[form]} - stays
    return {d: [line for n, line in enumerate((t or "").split("\n")) if (d, n) not in gone] for d, t in rows}


def removed_bytes(rows, length=100):
    """doc_id -> mask of the bytes that an earlier string covers."""
    seen, out = set(), {}
    for d, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        mask = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            own = raw[p : p + length]
            if own in seen:
                mask[p : p + length] = b"\1" * length
            seen.add(own)
        out[d] = (raw, mask)
    return out


def contaminated(rows, items):
    """doc ids that hold a window of an item's size whose weighted shingle similarity reaches 0.75."""
    from collections import Counter

    found = set()
    for d, text in rows:
        words = (text or "").lower().split()
        runs = {k: {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} for k in range(1, 6)}
        for _, item in items:
            own = (item or "").lower().split()
            n, k = len(own), min(5, len(own))
            # a window without a run of the item shares nothing
            if n and not any(tuple(own[i : i + k]) in runs[k] for i in range(n - k + 1)):
                continue
            want = Counter(tuple(own[i : i + k]) for i in range(n - k + 1)) if n else Counter()
            for s in range(len(words) - n + 1 if n else 0):
                have = Counter(tuple(words[s + i : s + i + k]) for i in range(n - k + 1))
                shared = sum((want & have).values())
                if 4 * shared >= 3 * sum((want | have).values()):
                    found.add(d)
                    break
    return found
