"""Small hard inputs for the operators, and brute-force versions of what they compute."""

import random
import re

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def words(n, seed, low=0, high=5000):
    rng = random.Random(seed)
    return [f"w{rng.randint(low, high)}" for _ in range(n)]


def hard_texts():
    """Null, empty, white, one word, repeated, long, odd characters."""
    long_ = " ".join(words(30_000, 1))
    return [None, "", "   \n\t ", "one", "a b", "x " * 400, long_, long_, "Été ça\u00a0là \x1c odd\x85line", "ΑΣ İ ß 漢字 😀 \u0308x",
            "<|endoftext|> in <|startoftext|> text", "\0 null \0", "tab\tand\nline\r\nends ", "A" * 5000, "A" * 5000 + "b"]


def documents(spark, texts, ids=None, extra=True):
    """(doc_id, text) with columns whose names the operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    if extra:
        for c in ("digest", "key", "n", "sig", "row", "rewritten", "score", "ids", "root", "start"):
            df = df.selectExpr("*", f"'own' AS {c}")
    return df


def copies_and_passages(seed=5):
    """Documents with exact and near copies and shared passages."""
    rng = random.Random(seed)
    base = [words(rng.randint(1, 260), 100 + i) for i in range(60)]
    passage = words(70, 7)
    texts = [" ".join(b) for b in base]
    for i in range(0, 60, 3):
        b = list(base[i])
        for _ in range(max(1, len(b) // rng.choice([20, 30, 60]))):
            b[rng.randrange(len(b))] = f"new{rng.randint(0, 9)}"
        texts.append(" ".join(b))
    for i in range(0, 60, 5):
        at = rng.randint(0, len(base[i]))
        texts.append(" ".join(base[i][:at] + passage + base[i][at:]))
    texts += [texts[3], texts[3].upper(), texts[4], " ".join(passage), " ".join(passage[:50]), " ".join(passage[:49])]
    rng.shuffle(texts)
    return texts


def near_components(rows, shingle=4, percent=80):
    """{id: (set size, component)} by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = [x.translate(UP) for x in SPLIT.findall(t or "")]
        sets[i] = {tuple(w[j : j + shingle]) for j in range(len(w) - shingle + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def without_repeats(rows, length=50):
    """{id: (words, removed, kept)} by a table of all windows."""
    split = {i: SPLIT.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(split):
        for j in range(len(split[i]) - length + 1):
            first.setdefault(tuple(split[i][j : j + length]), i)
    out = {}
    for i, w in split.items():
        gone = set()
        for j in range(len(w) - length + 1):
            if first[tuple(w[j : j + length])] < i:
                gone |= set(range(j, j + length))
        out[i] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out
