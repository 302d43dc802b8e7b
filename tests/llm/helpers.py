"""Small tables and brute-force versions for the tests of the training-data operators."""
import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows, extra=False):
    """A documents table; ``extra`` adds columns whose names clash with those of results."""
    df = spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows], DOCS)
    if extra:
        for name in ("kept", "component_id", "score", "lang_pred", "size", "taken", "n_words", "failed", "ids", "key", "id", "a", "b",
                     "stats", "held_out", "target"):
            df = df.selectExpr("*", f"'x' as {name}")
    return df


ODD = [(1, None, None, None), (2, "", "en", "s"), (3, " \n\t ", "en", None), (4, "a", None, "s"), (None, "word " * 60, "en", "s"),
       (5, "x" * 300_000 + " tail", "en", "t"), (6, "same text here for both rows now", "en", "s"),
       (6, "same text here for both rows now", "en", "s"), (7, "\x00\ufffd é ß 漢字 " * 30, "de", "t")]


def shingles(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(pairs, ids):
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    return least


def near_components(texts):
    """Component of each id of {id: text} by comparing all pairs that share a shingle."""
    sets, holders = {i: shingles(t) for i, t in texts.items()}, {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = set()
    for h in holders.values():
        pairs.update((a, b) for n, a in enumerate(h) for b in h[n + 1:])
    linked = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return components(linked, texts)


def near_copies(seed=3, groups=12, copies=14):
    """Texts in groups of edited copies; edits range from none to far beyond the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    out = {}
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(6, 160))]
        for _ in range(copies):
            words = list(base)
            for at in rng.sample(range(len(words)), int(len(words) * rng.choice([0, 0, .01, .02, .03, .04, .06, .1]))):
                words[at] = rng.choice(vocabulary)
            if rng.random() < .3:
                words += [rng.choice(vocabulary) for _ in range(rng.randint(0, len(words) // 3))]
            out[len(out)] = " ".join(words)
    return out
