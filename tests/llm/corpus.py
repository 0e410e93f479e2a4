"""A small corpus with every awkward case, and brute-force readings of the operators."""

import random
import re
from collections import Counter, defaultdict

SYLLABLES = "th an er in re on at en nd ou ti es or ha he éa ß ió".split()


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def text(rng, n):
    words = [word(rng) for _ in range(n)]
    return " ".join(w + ("\n" if rng.random() < 0.08 else "." if rng.random() < 0.1 else "") for w in words)


def corpus(seed=5):
    """(doc_id, text): plain texts, copies, near copies, shared passages, nulls, empties, a long text, repeated ids and a null id."""
    rng = random.Random(seed)
    rows = [(i, text(rng, rng.randint(1, 120))) for i in range(40)]
    passage, lines = text(rng, 40).replace("\n", " "), "\n".join(text(rng, 12).replace("\n", " ") for _ in range(4))
    base = text(rng, 150).split(" ")
    for i in range(40, 52):
        near = list(base)
        for _ in range(i - 40):
            near[rng.randrange(len(near))] = word(rng)
        rows.append((i, " ".join(near)))
    rows += [(60 + i, f"{text(rng, 10)} {passage} {text(rng, 8)}") for i in range(4)]
    rows += [(70 + i, f"{text(rng, 6)}\n{lines}\n\n\n{text(rng, 6)}") for i in range(3)]
    rows += [(80, rows[3][1]), (81, rows[3][1]), (82, None), (83, ""), (84, " \n\t\n"), (85, "a"), (86, "one two"), (87, text(rng, 6000))]
    rows += [(88, "same id"), (88, "another text of the same id"), (88, "same id"), (None, "no id at all here"), (None, rows[5][1])]
    rows += [(90, "LA " * 80), (91, "x" * 3000), (92, "İstanbul ΑΣ don't <|endoftext|> q<|startoftext|>y Ⅷ 日本 é \x1c \x85 ''s!"), (93, "a\\b [INST] </s>")]
    return rows


def frame(spark, rows=None, extra="lang string, chunk string, node int, tie string"):
    """documents with columns of clashing names."""
    rows = corpus() if rows is None else rows
    return spark.createDataFrame([(i, t, "en", "c", 1, "t") for i, t in rows], f"doc_id long, text string, {extra}")


def words(t, lower=False):
    t = t or ""
    if lower:
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t)
    return re.findall(r"[^\x20\x09-\x0D]+", t)


def shingles(t, k):
    w = words(t, lower=True)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    seen = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in seen[x])
        for x in s:
            seen[x].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                up[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            c = min(ids) if ids and sets[i] else rows[i][0]
            out.append((rows[i][0], len(sets[i]), c, rows[i][0] == c))
    return out


def repeated_bytes(rows, n):
    """Rows in order of id -> (doc_id, bytes, covered flags)."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, waiting, last, out = set(), set(), object(), []
    for doc_id, t in order:
        if doc_id != last:
            seen |= waiting
            waiting, last = set(), doc_id
        raw = (t or "").encode()
        flags = bytearray(len(raw))
        for i in range(len(raw) - n + 1):
            w = raw[i : i + n]
            if w in seen:
                flags[i : i + n] = b"\1" * n
            waiting.add(w)
        out.append((doc_id, raw, bytes(flags)))
    return out


def by_row(rows):
    return sorted(map(tuple, rows), key=str)
