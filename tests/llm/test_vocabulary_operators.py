"""Source divergence, document quality and spelling groups, held against brute force or held-out rows."""
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermill.llm import divergence, quality, spelling

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_divergence(rows, least, top):
    """``rows``: (lang, source, text). Counts in dictionaries, every pair of sources term by term."""
    rows = [tuple(x or "" for x in r) for r in rows]
    docs, count, total = Counter(), Counter(), Counter()
    for lang, source, text in rows:
        found = TERM.findall(text.translate(LOWER))
        docs.update((lang, w) for w in set(found))
        count.update((lang, source, w) for w in found)
    out = []
    for lang in {r[0] for r in rows}:
        sources = sorted({r[1] for r in rows if r[0] == lang})
        kept = sorted(w for (a, w), n in docs.items() if a == lang and n >= least)
        total = {s: sum(count[lang, s, w] for w in kept) for s in sources}

        def share(n, whole, kinds=len(kept)):
            return 1 + 10 ** 9 * (n + 2) // (whole + 2 * kinds)

        def far(p, q):
            return (p - q) ** 2 // (p + q)

        for s in sources:
            pair = sorted((-sum(far(share(count[lang, s, w], total[s]), share(count[lang, o, w], total[o])) for w in kept),
                           o.encode(), o) for o in sources if o != s)
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(pair)]
            terms = []
            for w in kept:
                p = share(count[lang, s, w], total[s])
                q = share(sum(count[lang, o, w] for o in sources), sum(total.values()))
                if count[lang, s, w] and p > q:
                    terms.append((-far(p, q), w.encode(), w))
            out += [(lang, s, "term", w, -v, k + 1) for k, (v, _, w) in enumerate(sorted(terms)[:top])]
    return sorted(out)


def corpus(rng):
    vocabulary = ["a", "ab", "the", "eightlet", "ninelette", "sixteenletterses", "seventeenletterss", "é" * 8, "ñandú",
                  "🙂face", "x" * 40, "y" * 5000, "Z" * 33, "日本語", "ß", "word"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)]
    rows = []
    for k in range(160):
        lang, source = rng.choice(["en", "fr", None, ""]), rng.choice(["s1", "S2", "s3", None, "ü", "s1", "s1"])
        body = [rng.choice(vocabulary[: 20 + 15 * (k % 5)]) for _ in range(rng.randrange(0, 60))]
        rows.append((lang, source, rng.choice([" ", "-", "\x00", "9"]).join(w.title() if rng.random() < .3 else w for w in body)))
    rows += [("en", "empty", None), ("en", "empty", ""), ("de", "alone", "nur einmal"), ("it", "one", "1234 !!"), ("it", "two", "")]
    return rows + rows[:9]


@pytest.mark.parametrize("blocks", [(32, 4096), (2, 7)])
def test_divergence(spark, monkeypatch, blocks):
    monkeypatch.setattr(divergence, "PENDING", 400)  # tasks send their sums often
    rows = corpus(random.Random(8))
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, n int, term string")
    out = divergence.divergence(docs, 3, 4, *blocks).collect()
    assert sorted(tuple(r) for r in out) == brute_divergence(rows, 3, 4)
    assert divergence.divergence(docs.limit(0)).count() == 0


def test_shares_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    row = spark.sql("SELECT 30000000000L AS n, 90000000000L AS t, 5L AS v").select(
        divergence._share(F.col("n"), F.col("t"), F.col("v")).alias("p")).first()
    assert row.p == 1 + 10 ** 9 * (30_000_000_002) // (90_000_000_010)


@given(st.lists(st.tuples(st.sampled_from(["s", "t"]), st.text("abAB\x00 éñ🙂", max_size=60)), max_size=12))
@settings(max_examples=60, deadline=None)
def test_packed_counts(rows):
    counts, want = divergence.TermCounts(), Counter()
    for k, (source, text) in enumerate(rows):
        raw = text.encode()
        counts.add(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), np.array([counts.group("", source)], np.uint32))
        found = TERM.findall(text.translate(LOWER))
        want.update((source, w, "n") for w in found)
        want.update((source, w, "d") for w in set(found))
        if k % 4 == 3:
            counts._merge()
    got = Counter()
    for batch in counts.flush():
        for r in batch.to_pylist():
            if r["term"] is not None:
                got.update({(r["source"], r["term"], "n"): r["n"], (r["source"], r["term"], "d"): r["n_docs"]})
    assert got == want


def learnable(rng, n):
    good = ["river", "stone", "and", "the", "walked", "over", "hill", "quiet", "morning"]
    rows = []
    for k in range(n):
        words, bad = [rng.choice(good) for _ in range(rng.randrange(5, 60))], k % 4 == 0
        text = " ".join(w.upper() + "!!" for w in words) if bad and k % 8 else " ".join(words) + "."
        rows.append((k, text if not bad or k % 8 else " ".join([words[0]] * 30), 0 if bad else 1))
    return rows


def test_quality_on_held_out_rows(spark):
    rows = learnable(random.Random(2), 900)
    docs = spark.createDataFrame([(i, t, 0.5, 1) for i, t, _ in rows] + [(None, "no id", 0.5, 1), (9001, None, 0.5, 1), (9002, "", 0.5, 1),
                                 (9003, "long text " * 40_000, 0.5, 1), (3, rows[3][1], 0.5, 1), (3, "another text", 0.5, 1)],
                                 "doc_id long, text string, score double, y int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, None), (3, 0), (None, 1), (77777, 1)], "doc_id long, quality int")
    out = quality.judged(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= .7) for r in out)
    truth = {i: y for i, _, y in rows}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > .97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out if r.doc_id is not None)
    by_id = defaultdict(list)
    for r in out:
        by_id[r.doc_id].append(r.score)
    assert by_id[9001] == by_id[9002] and by_id[None] and len(by_id[3]) == 3
    assert sorted((r.doc_id or -1, r.score) for r in out) == sorted((r.doc_id or -1, r.score) for r in quality.judged(docs, labels).collect())
    assert quality.judged(docs.limit(0), labels).count() == 0
    assert {r.score for r in quality.judged(docs, labels.limit(0)).collect()} == {.5}


def test_held_out_labels_are_not_learned(spark):
    rows = learnable(random.Random(3), 300)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    one, two = (spark.createDataFrame([(i, 1 - y if flip and i in held else y) for i, _, y in rows], "doc_id long, quality int")
                for flip in (False, True))
    assert (quality.fit(docs, one) == quality.fit(docs, two)).all()


def test_leader_follows_the_definition():
    """Per-coordinate updates written out, against the vectorised ones."""
    rng, leader = np.random.default_rng(1), quality.Leader()
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * quality.L1) / ((quality.BETA + n[i] ** .5) / quality.ALPHA + quality.L2)

    for _ in range(200):
        at, y = rng.choice(50, 6, replace=False), int(rng.integers(2))
        x = rng.random(6)
        p = 1 / (1 + np.exp(-sum(weight(i) * v for i, v in zip(at, x, strict=True))))
        for i, v, w in [(i, v, weight(i)) for i, v in zip(at, x, strict=True)]:
            g = (p - y) * v
            z[i] += g - ((n[i] + g * g) ** .5 - n[i] ** .5) / quality.ALPHA * w
            n[i] += g * g
        leader.learn(at, x, y)
    assert np.allclose(leader.weights()[:50], [weight(i) for i in range(50)])
    assert len(quality.score_texts(leader.weights(), pa.array(["", None, "a a"]))) == 3


def brute_words(rows, length, least):
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= length and n >= least}


def near(a, b):
    """One inserted, deleted or replaced character, by trying all places."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_forms(words, ratio=5):
    out, form = {}, {}
    for w, n in words.items():
        close = [(-m, v) for v, m in words.items() if near(w, v)]
        best = min(close, default=None)
        form[w] = best[1] if best and -best[0] >= ratio * n else None
        out[w] = (n, len(close), words[form[w]] if form[w] else None)
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, *out[w])
    return out


def spelled(rng, n):
    base = ["correct", "spelling", "ñandúes", "straße", "éclairs", "aaaaaa", "aaaaaaa", "abcabcabc", "banana"]
    rows = []
    for k in range(n):
        body = []
        for _ in range(rng.randrange(0, 40)):
            w = rng.choice(base[: 3 + k % 7])
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2, 3])):
                at, c = rng.randrange(len(w)), rng.choice("abé")
                w = rng.choice([w[:at] + c + w[at + 1:], w[:at] + w[at + 1:], w[:at] + c + w[at:]]) or "x"
            body.append(w.title() if rng.random() < .2 else w)
        rows.append((k, rng.choice([" ", "1", ", "]).join(body)))
    return rows + [(None, "correct correct"), (n, None), (n + 1, ""), (n + 2, "spelling " * 3000), (5, rows[5][1]), (5, "banana")]


@pytest.mark.parametrize("least, block", [(2, 4096), (1, 5)])
def test_spelling_forms(spark, least, block):
    rows = spelled(random.Random(6), 150)
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int")
    want = brute_forms(brute_words(rows, 6, least))
    out = spelling.forms(docs, block=block, least_count=least).collect()
    assert len(out) == len(want) and any(r.root not in (r.word, r.form) for r in out)
    for r in out:
        assert (r.form, r.root, r.n, r.n_near, r.form_n) == want[r.word], r
    assert spelling.forms(docs.limit(0)).count() == 0


@given(st.lists(st.text("abé", min_size=2, max_size=8), max_size=30, unique=True))
@settings(max_examples=150, deadline=None)
def test_scan_finds_each_pair_once(words):
    """All groups of a small list, one tile or two, count each near pair once from both ends."""
    for blocks in (1, 2):
        got = Counter()
        for short in range(1, 9):
            for backward in (False, True):
                groups = defaultdict(list)
                for w in words:
                    if len(w) in (short, short + 1):
                        groups[w[len(w) - short // 2:] if backward else w[:short // 2]].append(w)
                for group in groups.values():
                    code, n, side = [w.encode("latin-1") for w in group], [1] * len(group), [len(w) % blocks for w in group]
                    for p in range(blocks):
                        for q in range(p, blocks):
                            here = [k for k in range(len(group)) if side[k] in (p, q)]
                            if len(here) > 1:
                                best = spelling.near_in_group([code[k] for k in here], [n[k] for k in here],
                                                              [side[k] for k in here], short, backward, p, q)
                                got.update({group[here[k]]: v[0] for k, v in best.items()})
        assert got == {w: c for w in words if (c := sum(near(w, v) for v in words))}
