"""Operators 3 and 10 against brute force and held-out accuracy, and their edge cases."""

import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from carewatch.llm import quality, registry, toxicity

SF = "/root/testdata/sf0.01"


def edge(spark):
    rows = [(1, None, "en"), (2, "", None), (3, " \n ", "xx"), (4, "a b c d e f g h i j " * 3000, "en"),
            (None, "idiot # one\nidiot # one\n" * 2, "de"), (5, "漢字 😀 ß É", None), (5, "漢字 😀 ß É", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for c in ("kept", "n_words", "score", "passages", "KEPT2", "predicted"):
        df = df.withColumn(c, F.lit("old"))
    return df


def slow_base(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = (text or "").split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search("[^\x20\x09-\x0d]", x) and x in lines[:i])
    win = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    many = {w for w in win if win.count(w) > 1} if len(win) < 400 else \
        {w for w, k in __import__("collections").Counter(win).items() if k > 1}
    inside = {j for i, w in enumerate(win) if w in many for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside))


def test_base_counts():
    rng = random.Random(1)
    for _ in range(400):
        t = "".join(rng.choice(["a ", "b ", "a b c d e ", "x\n", "é|", "\n", "\t", "#% ", "\x85", "\xa0", "\x1c"])
                    for _ in range(rng.randint(0, 60)))
        assert quality.base_counts(t) == slow_base(t), repr(t)
    assert quality.base_counts(None) == (0, 0, 0, 0, 0)


def test_distance():
    a, b = np.array([1.0, 0, 0]), np.array([0.0, 2, 2])
    assert quality.distance(a, b) == 1.0 and quality.distance(b, b) == 0.0
    p, q = np.array([3.0, 1]), np.array([1.0, 1])
    m = (p / 4 + q / 2) / 2
    want = sum(x * math.log2(x / y) / 2 for x, y in zip(p / 4, m)) + sum(x * math.log2(x / y) / 2 for x, y in zip(q / 2, m))
    assert abs(quality.distance(p, q) - math.sqrt(want)) < 1e-12


def test_quality_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    refs = {}
    for lang in {r["lang"] for r in docs}:
        chars, words = np.zeros(6), {}
        for r in docs:
            if r["lang"] == lang and r["text"]:
                chars += quality.char_classes(r["text"], r["text"].encode())
                for w in re.findall("[^\x20\x09-\x0d]+", r["text"].lower()):
                    words[w] = words.get(w, 0) + 1
        top = sorted(words, key=lambda w: (-words[w], w.encode()))[:quality.COMMON]
        hist = np.array([words[w] for w in top] + [0.0])
        hist[-1] = sum(words.values()) - hist.sum()
        refs[lang] = (chars, {w.encode(): i for i, w in enumerate(top)}, hist)
    got = {r["doc_id"]: r for r in registry.QUERIES["op3_quality_rules"](spark, SF).collect()}
    assert len(got) == len(docs)
    for r in docs:
        base = slow_base(r["text"])
        g = got[r["doc_id"]]
        assert tuple(g[1:6]) == base
        assert g["base_failed"] == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        want = quality.judge(r["text"], refs[r["lang"]])
        assert g["kept"] == want[8] and abs(g["word_distance"] - want[7]) < 1e-9
        assert abs(g["char_distance"] - want[6]) < 1e-9
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good = [got[r["doc_id"]] for r in labels if r["quality"] == 1]
    bad = [got[r["doc_id"]] for r in labels if r["quality"] == 0]
    assert sum(g["kept"] for g in good if not g["base_failed"]) >= 0.99 * sum(not g["base_failed"] for g in good)
    assert sum(g["kept"] for g in bad) <= 0.1 * len(bad)


def test_quality_edges(spark):
    out = quality.quality_rules(edge(spark))
    assert out.columns.count("kept") == 1 and "KEPT2" in out.columns
    by = {r["doc_id"]: r for r in out.collect()}
    assert by[1]["n_words"] == 0 and by[1]["base_failed"] and not by[2]["kept"]
    assert by[4]["n_words"] == 30_000 and by[4]["n_repeat_words"] == 30_000
    assert by[None]["n_dup_lines"] == 3 and by[None]["n_symbols"] == 4
    assert quality.quality_rules(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_segments_are_maximal():
    """Against the definition: split at the leftmost best segment and go on on both sides."""
    def slow(s, a, b):
        best, at = 0.0, None
        for i in range(a, b):
            for j in range(i, b):
                v = sum(s[i:j + 1])
                if v > best + 1e-9 or (at and abs(v - best) < 1e-9 and j - i < at[1] - at[0] and i >= at[0] and j <= at[1]):
                    best, at = v, (i, j)
        if at is None:
            return []
        return slow(s, a, at[0]) + [(*at, best)] + slow(s, at[1] + 1, b)
    rng = random.Random(4)
    for _ in range(300):
        s = [rng.uniform(-3, 2.5) for _ in range(rng.randint(1, 18))]
        got = toxicity.segments(np.array(s))
        want = slow(s, 0, len(s))
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_lambda():
    values, p = np.array([-1.0, 1.0]), np.array([0.75, 0.25])
    assert abs(toxicity.solve_lambda(values, p) - math.log(3)) < 1e-9


def auc(y, s):
    pos, neg = [b for a, b in zip(y, s) if a], [b for a, b in zip(y, s) if not a]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    scored = registry.QUERIES["op10_toxicity"](spark, sf).join(
        spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in scored)
    held = [r for r in scored if r["held_out"]]
    assert auc([r["toxic"] for r in held], [r["score"] for r in held]) > 0.95
    hit = [r["toxic"] for r in held if r["predicted"]]
    assert sum(hit) / len(hit) > 0.95 and sum(hit) > 0.85 * sum(r["toxic"] for r in held)
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in scored)


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(40)] + [(None, 1, None), (3, None, None)],
                                   "doc_id long, toxic int, x string")
    docs = spark.createDataFrame([(i, "you idiot moron scum" if i % 2 else "a fine day") for i in range(40)],
                                 "doc_id long, text string")
    model = toxicity.train(docs, labels)
    out = toxicity.toxicity(edge(spark), model)
    assert out.columns.count("score") == 1
    rows = out.collect()
    assert len(rows) == 7 and {r["score"] for r in rows if r["doc_id"] in (1, 2, 3)} == {model.probability([])}
    none = toxicity.train(docs.limit(0), labels)
    assert {r["predicted"] for r in toxicity.toxicity(edge(spark), none).collect()} == {0}
    assert toxicity.toxicity(docs.limit(0), model).count() == 0


def test_rare_and_null_languages(spark):
    """A rare language has its own reference; without one only the base rules reject."""
    rng = random.Random(5)

    def texts(alphabet, n):
        words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(2, 9))) for _ in range(300)]
        return [" ".join(words[min(299, int(rng.expovariate(0.05)))] for _ in range(80)) for _ in range(n)]

    latin, greek, other = texts("abcdefghij", 4000), texts("αβγδεζηθικ", 100), texts("бвгджзклмн", 5)
    rows = [(t, "aa") for t in latin] + [(t, "gg") for t in greek[:40]] + [(t, None) for t in greek[40:]] + [
        (t, "zz") for t in other]
    rows += [(t, "aa") for t in latin * 10]  # gg is under 0.1 %
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    at_once = {r["doc_id"]: r for r in quality.quality_rules(df).collect()}
    joined = {r["doc_id"]: r for r in quality.quality_rules(df, held=1).collect()}
    assert len(at_once) == len(joined) == len(rows) and at_once == joined
    for i, (_, lang) in enumerate(rows):
        if lang != "aa" and not at_once[i]["base_failed"]:
            assert at_once[i]["kept"]
            assert (at_once[i]["word_distance"] > 0) == (lang == "gg")
    # the reference is a language's own: a text of another one is far from it
    mislabelled = df.withColumn("lang", F.when(F.col("doc_id") == 0, "gg").otherwise(F.col("lang")))
    assert not {r["doc_id"]: r["kept"] for r in quality.quality_rules(mislabelled).collect()}[0]


def test_repeats_count_once_inside_a_segment():
    def slow(words, s):
        best = 0.0
        for i in range(len(s)):
            seen, v = set(), 0.0
            for j in range(i, len(s)):
                v += -toxicity.MARGIN if s[j] > 0 and words[j] in seen else s[j]
                seen.add(words[j])
                best = max(best, v)
        return best
    rng = random.Random(6)
    value = {w: rng.uniform(0.2, 4) if w < "e" else -toxicity.MARGIN for w in "abcdefghij"}
    for _ in range(600):
        words = [rng.choice("abcdefghij") for _ in range(rng.randint(1, 40))]
        scores = np.array([value[w] for w in words])
        for a, b, _ in toxicity.segments(scores):
            assert abs(toxicity.distinct_score(words[a:b + 1], scores[a:b + 1]) - slow(words[a:b + 1], scores[a:b + 1])) < 1e-9


def test_passages_of_long_texts():
    """Words that stood alone before, or a passage that comes again, are found all the same."""
    toxic = ["idiot", "moron", "scum", "vermin"]
    model = toxicity.Model(scores={w + "$": 4.0 for w in toxic}, lam=1.0, log_k=-1.0)
    gap = " fine" * 400
    once = gap + " " + " ".join(toxic) + gap
    alone = "".join(gap + " " + w for w in toxic)
    assert len(model.passages(once)) == 1 and not model.passages(alone)
    assert [p[:2] for p in model.passages(alone + once)] == [(2004, 2007)]
    assert len(model.passages(once + once)) == 2
    assert not model.passages(" idiot" * 100 + gap)  # one word again and again is no passage


def test_scan_of_very_long_texts():
    """500,000 words, few of them and all of them positive, in seconds."""
    import time
    n = 500_000
    began = time.time()
    assert len(toxicity.segments(np.tile([1.0, -2.0], n // 2))) == n // 2
    assert len(toxicity.segments(np.concatenate([np.tile([1.0, -2.0], n // 4), np.tile([3.0, -1.0], n // 4)]))) > 1
    rng = random.Random(2)
    for kinds in (5, 3000, 10 ** 9):
        words = [f"w{rng.randrange(kinds)}" for _ in range(n)]
        scores = np.array([rng.uniform(0.1, 3) for _ in range(n)])
        assert toxicity.distinct_score(words, scores) > 0
    assert time.time() - began < 60
    model = toxicity.Model(scores={"idiot$": 4.0, "scum$": 4.0}, lam=1.0, log_k=-1.0)
    assert len(model.passages(("idiot scum " + "fine " * 30) * 15_000)) == 0 and time.time() - began < 90


def brute_segments(s):
    """Maximal segments by walking back over all candidates."""
    out, total = [], np.concatenate(([0.0], np.cumsum(s)))
    for i in np.flatnonzero(s > 0).tolist():
        first, before, after = i, total[i], total[i + 1]
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= before:
                j -= 1
            if j < 0 or out[j][3] >= after:
                out.append((first, i, before, after))
                break
            first, before = out[j][0], out[j][2]
            del out[j:]
    return [(a, b) for a, b, _, _ in out]


def brute_best(words, s):
    best = 0.0
    for i in range(len(s)):
        v, seen = 0.0, set()
        for j in range(i, len(s)):
            v += -toxicity.MARGIN if s[j] > 0 and words[j] in seen else s[j]
            seen.add(words[j])
            best = max(best, v)
    return best


def test_toxicity_query_equals_brute_force(spark):
    """The whole query again in plain loops: word statistics, scores, passages, calibration."""
    sf = "/root/testdata/sf0.01"
    text = {r[0]: r[1] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    known = {}
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        if r["toxic"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 and r["doc_id"] in text:
            known[r["doc_id"]] = max(known.get(r["doc_id"], 0), r["toxic"])
    fold = {r[0]: r[1] >= 7 for r in spark.createDataFrame([(i,) for i in known], "i long").select(
        "i", F.expr("pmod(xxhash64(i, 'fold'), 10)")).collect()}
    strip = toxicity.STRIP

    def chain(word):
        w = word.strip(strip)
        return [w[:k] for k in (3, 4, 5, 6) if len(w) > k] + [w + "$"] if w else []

    seen = [{u for w in t.lower().split() for u in chain(w)} for t in (text[i] for i in known if not fold[i])]
    label = [known[i] for i in known if not fold[i]]
    n1, n0 = sum(label), len(label) - sum(label)
    y = {}
    for units, toxic in zip(seen, label):
        for u in units:
            y.setdefault(u, [0, 0])[toxic] += 1
    y = {u: c for u, c in y.items() if c[1] >= 1 or c[0] >= 3}
    rate = {}
    for u in sorted(y, key=lambda u: (u[-1] == "$", len(u), u)):
        w = u[:-1] if u[-1] == "$" else u
        p = next((rate[w[:k]] for k in (6, 5, 4, 3) if k < len(w) and w[:k] in rate), n1 / (n1 + n0))
        rate[u] = (y[u][1] + 8.0 * p) / (sum(y[u]) + 8.0)
    odds = lambda p: math.log(p / (1 - p))

    def value(word):
        return next((odds(rate[u]) - odds(n1 / (n1 + n0)) for u in chain(word)[::-1] if u in rate), 0.0) - 0.7

    def scan(t):
        words = t.lower().split()
        s = np.array([value(w) for w in words])
        bare = [w.strip(strip) for w in words]
        return s, [brute_best(bare[a:b + 1], s[a:b + 1]) for a, b in brute_segments(s)]
    scanned = {i: scan(t) for i, t in text.items()}
    fit = [i for i in known if fold[i]]
    clean = [v for i in fit if not known[i] for v in np.round(scanned[i][0], 1).tolist()]
    values = sorted(set(clean))
    lam = toxicity.solve_lambda(np.array(values), np.array([clean.count(v) for v in values]) / len(clean))
    best = [lam * max(scanned[i][1]) - math.log(len(scanned[i][0])) for i in fit if not known[i] and scanned[i][1]]
    log_k = sum(best) / len(best) - 0.5772

    def evidence(i):
        s, parts = scanned[i]
        return sum(max(0.0, lam * v - log_k - math.log(len(s))) for v in parts)
    slope, bias = toxicity.logistic_fit(np.array([evidence(i) for i in fit]), np.array([float(known[i]) for i in fit]))
    for r in registry.QUERIES["op10_toxicity"](spark, sf).collect():
        want = 1 / (1 + math.exp(-max(-700.0, min(700.0, bias + max(0.0, slope) * evidence(r["doc_id"])))))
        assert abs(r["score"] - want) < 1e-6 and r["predicted"] == int(r["score"] >= 0.7)
        s, parts = scanned[r["doc_id"]]
        assert r["n_passages"] == sum(lam * v - log_k - math.log(len(s)) > 0 for v in parts)
