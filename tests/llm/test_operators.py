"""The operators against brute force, on small hard tables."""
import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermill.llm import (
    automata,
    components,
    grid_join,
    hyper_minhash,
    kneser_ney,
    packing,
    personal_data,
    pieces,
    sharding,
    spans,
    token_counts,
    topk,
    toxicity,
)
from ledgermill.llm.byte_bpe import vocabulary_path

LONG = "long words repeated here, " * 4000
TEXTS = ["", None, " ", "a", "Plain text of some words.", "Plain text of some words.", "  two  blanks\n\n new\tline \n",
         " odd space\x0b\n x", "▁marked ▁▁ text", "ünïcödé 🙂 🙃 ﬁ", "don't stop'll", "1234 5678\r\n9", LONG, "x" * 5000]
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns named like results."""
    rows = [(i, t, "en", 7, 1) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "en", 7, 1), (None, "no id", "en", 7, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, shard int, length int")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def test_pieces_and_packing(docs, none):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    out = packing.pack_documents(docs).collect()
    ids = {i: model.encode(t or "", add_special_tokens=False).ids + [2] for i, t in [*enumerate(TEXTS), (None, "no id")]}
    for r in out:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length <= 1024 and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
    assert sum(r.length for r in out) == sum(map(len, ids.values())) + len(ids[4])
    for number in {r.sequence_id for r in out}:
        at = 0
        for r in sorted((r for r in out if r.sequence_id == number), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert packing.pack_documents(none).count() == 0


@given(st.dictionaries(st.integers(1, 30), st.integers(0, 50)))
@settings(max_examples=150, deadline=None)
def test_plan_places_every_piece_once(histogram):
    used = Counter()
    taken = {}
    for n, low, high, first, per, offset in packing.plan(histogram, 30):
        assert taken.get(n, 0) == low
        taken[n] = high
        for r in range(high - low):
            bin_, at = first + r // per, offset + r % per * n
            assert used[bin_] == at
            used[bin_] += n
    assert all(v <= 30 for v in used.values())
    assert {n: c for n, c in histogram.items() if c} == taken
    total = sum(n * c for n, c in histogram.items())
    assert len(used) <= max(2 * -(-total // 30), 1)


def test_length_histogram(docs, none):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    lengths = np.array([len(model.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()])
    sums = token_counts.with_suffix_sums(token_counts.length_histogram(docs))
    rows = sums.collect()
    assert {r.length: r.n_docs for r in rows} == Counter(lengths.tolist())
    for r in rows:
        assert r.docs_over == (lengths > r.length).sum() and r.truncated_total == np.minimum(lengths, r.length).sum()
    for limit in (0, 1, 7, 300, 10 ** 6):
        assert token_counts.truncated_total(sums, limit).first()[0] == np.minimum(lengths, limit).sum()
    assert token_counts.quantile(sums, 0.5).first()[0] == np.sort(lengths)[(len(lengths) - 1) // 2]
    assert token_counts.with_suffix_sums(token_counts.length_histogram(none)).count() == 0


def test_sentence_pieces(docs, none):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    for r in pieces.encode_documents(docs, with_results=True).collect():
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        ids = model.encode(text, add_bos=True, add_eos=True)
        assert r.ids == ids and r.decoded == model.decode(ids) and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert pieces.encode_documents(none).count() == 0


def test_sharding(docs, none):
    rows = sharding.shard_by_bytes(docs, shards=3, ranges=8, sample=16).collect()
    assert len(rows) == docs.count()
    sizes = Counter()
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    for r in rows:
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        assert r["size"] == len(text.encode()) + 16 and r.text_crc32 == zlib.crc32(text.encode())
        sizes[r.shard] += r["size"]
    most = max(r["size"] for r in rows)
    assert all(abs(sizes[k] - sum(sizes.values()) / 3) <= most for k in range(3))
    assert sharding.shard_by_bytes(none).count() == 0


@pytest.mark.parametrize(("ranges", "most_rows"), [(1, 40), (4, 9), (64, 500_000)])
def test_overfull_ranges_are_subdivided(spark, ranges, most_rows):
    """One key has nine tenths of the rows; every record stands where sorting all of them puts it."""
    docs = spark.range(900).selectExpr("CAST(7 AS bigint) AS doc_id", "'copy' AS text").unionByName(
        spark.range(100).selectExpr("id + 100 AS doc_id", "concat('text ', id, repeat('y', int(id))) AS text"))
    keyed = sharding.written(sharding.records(docs), "keyed")
    placed = keyed.withColumn("range", sharding.F.lit(0))
    sums = placed.groupBy("range").agg(sharding.F.count("key").alias("n"))
    cuts = sharding.subdivisions(placed, sums, most_rows).collect()
    assert bool(cuts) == (most_rows < 1000) and all(r.cuts == sorted(r.cuts) for r in cuts)
    if cuts:
        bounds, keys = cuts[0].cuts, [r.key for r in keyed.select("key").collect()]
        pieces_ = Counter(sum(tuple(b) <= tuple(k) for b in bounds) for k in keys)
        assert max(pieces_.values()) <= 4 * most_rows
    order = sorted(keyed.collect(), key=lambda r: tuple(r.key))
    total, at, want = sum(r["size"] for r in order), 0, Counter()
    for r in order:
        want[r.doc_id, min(4, int((2 * at + r["size"]) * 5 / (2 * total)))] += 1
        at += r["size"]
    out = sharding.shard_by_bytes(docs, shards=5, ranges=ranges, sample=8 * ranges, most_rows=most_rows).collect()
    assert Counter((r.doc_id, r.shard) for r in out) == want
    for shard in range(5):
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_shards_of_many_copies_are_even(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'the same text', repeat('x', int(id % 50))) AS text")
    rows = sharding.shard_by_bytes(docs, ranges=64, sample=512).groupBy("shard").sum("size").collect()
    assert len(rows) == 40 and max(r[1] for r in rows) - min(r[1] for r in rows) <= 132


BAD = [(90, None), (91, []), (92, [0.0] * 4), (93, [float("nan"), 1.0, 0.0, 0.0]), (94, [None, 1.0, 0.0, 0.0]),
       (95, [float("inf"), 0.0, 0.0, 0.0]), (96, [1.0, 2.0]), (97, [2.0, 4.0]), (None, [1.0, 0.0, 0.0, 0.0])]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(12, 4))
    rows = [(i, (base[i % 12] + rng.normal(size=4) * 0.12).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(5)]
    return spark.createDataFrame([(*r, 1) for r in [*rows, *BAD]], "vec_id long, embedding array<double>, n_links int")


def test_grid_order_join(vectors):
    rows = [r for r in vectors.collect() if r.vec_id is not None and r.vec_id not in range(90, 96)]
    near = {r.vec_id: set() for r in rows}
    for a in rows:
        for b in rows:
            x, y = np.array(a.embedding), np.array(b.embedding)
            if a.vec_id != b.vec_id and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9:
                near[a.vec_id].add(b.vec_id)
    out = grid_join.near_duplicates(vectors, interval=7, leaf=3).collect()
    assert len(out) == vectors.count()
    for r in out:
        todo, seen = [r.vec_id], {r.vec_id}
        while todo:
            fresh = near.get(todo.pop(), set()) - seen
            seen |= fresh
            todo += fresh
        assert r.n_links == len(near.get(r.vec_id, ()))
        assert r.vec_id is None or (r.component_id == min(seen) and r.kept == (r.vec_id == min(seen)))
    assert grid_join.near_duplicates(vectors.limit(0)).count() == 0


def test_tiles_of_intervals(vectors, monkeypatch):
    """A tile of several intervals gives what single pairs give."""
    monkeypatch.setattr(grid_join, "_tile", lambda intervals, lanes: 1)
    one = grid_join.near_duplicates(vectors, interval=5, leaf=3).collect()
    monkeypatch.setattr(grid_join, "_tile", lambda intervals, lanes: 4)
    assert sorted(map(str, grid_join.near_duplicates(vectors, interval=5, leaf=3).collect())) == sorted(map(str, one))


def test_top_k(vectors):
    whole = topk.whole_numbers(vectors)
    rows = {r.vec_id: np.array(r.v, np.int64) for r in whole.collect()}
    assert set(rows) & {90, 91, 93, 94, 95, None} == set()
    out = topk.top_k(whole, whole.where("vec_id % 20 = 0"), k=5, block=9, query_block=2).collect()
    for q in (i for i in rows if i % 20 == 0):
        want = sorted((-int(v @ rows[q]), i) for i, v in rows.items() if i != q and len(v) == len(rows[q]))[:5]
        assert [(-r.score, r.vec_id) for r in sorted((r for r in out if r.query_id == q), key=lambda r: r["rank"])] == want
    assert topk.top_k(whole.limit(0), whole.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 200)] + [(7, 7), (None, 3)]
    links += [(b, a) for a, b in links[:10]]
    rng.shuffle(links)
    out = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 200)}


def brute_groups(texts, n, share):
    sets = {i: ({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
            for i, w in ((i, words(t)) for i, t in texts.items())}
    root = {i: i for i in texts}
    for a in sorted(sets):
        for b in sorted(sets):
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= share * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return sets, root


def test_near_duplicates(spark, docs, none):
    rng = random.Random(1)
    texts = {}
    for g in range(12):
        base = [f"w{rng.randrange(300)}" for _ in range(60)]
        for k in range(6):
            copy = list(base)
            for _ in range(k):
                copy[rng.randrange(60)] = f"n{rng.randrange(999)}"
            texts[100 * g + k] = " ".join(copy).title()
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets, root = brute_groups(texts, 2, 80)
    for r in hyper_minhash.near_duplicates(frame, words=2, tile=4, load=150).collect():
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root[r.doc_id])
    out = hyper_minhash.near_duplicates(docs, words=2).collect()
    sets, root = brute_groups(dict(enumerate(TEXTS)), 2, 80)
    assert len(out) == docs.count()
    for r in out:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root[r.doc_id])
            assert r.kept == (r.doc_id == r.component_id)
    assert hyper_minhash.near_duplicates(none).count() == 0


def test_registers_estimate_similarity():
    rng = np.random.default_rng(2)
    donors = hyper_minhash._donors(240)
    pool = rng.integers(0, 2 ** 64, 3000, dtype=np.uint64)
    for common in (0, 600, 900):
        a, b = np.unique(pool[:1000]), np.unique(np.concatenate([pool[:common], pool[1000:2000 - common]]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        regs = [hyper_minhash.registers_of(x, donors) for x in (a, b)]
        got = hyper_minhash.similarity(regs[0][None], regs[1][None], np.array([len(a)]), np.array([len(b)]))[0]
        assert abs(got - true) < 0.15


def test_kneser_ney(spark, docs, none):
    import math
    out = {r.doc_id: r for r in kneser_ney.scored(docs.dropDuplicates(["doc_id"])).collect()}
    train = [words(t) + [0] for i, t in enumerate(TEXTS) if zlib.crc32(str(i).encode()) % 10]
    counts = Counter(w for t in train for w in t)
    total, kinds = sum(counts.values()), len(counts)
    for i, t in enumerate(TEXTS):
        own, r = words(t) + [0], out[i]
        base = sum(math.log10((counts[w] + .1) / (total + .1 * (kinds + 1))) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(base) and r.score < 0
        assert r.held_out == (zlib.crc32(str(i).encode()) % 10 == 0)
    assert kneser_ney.scored(none).count() == 0


def test_kneser_ney_is_a_distribution(spark):
    import pyarrow as pa
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(25)]
    lines = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 12))) for _ in range(200)]
    model = kneser_ney.train(spark.createDataFrame([(x,) for x in lines], "text string"), parts=4)
    for context in ("w3", "w9 w4", "unheard"):
        mass = 0.0
        for nxt in (*vocabulary, "never", None):
            text = context if nxt is None else f"{context} {nxt}"
            at = len(context.split())
            (_, _, _, _, _, score), = kneser_ney.log10_scores(pa.array([text]), model)
            mass += 10 ** score[at]
        assert mass == pytest.approx(1)


def base_by_pattern(text):
    def luhn(d):
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(d))]
        return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        out += [(m.start(), 2, m.end())] if 12 <= len(digits) <= 19 and luhn(digits) else []
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out)


@given(st.text(alphabet="0123456789.+-() @ab\né", max_size=60))
@settings(max_examples=400, deadline=None)
def test_base_spans(text):
    assert personal_data.base_spans(text) == base_by_pattern(text)


def test_personal_data(spark, docs, none):
    rng = random.Random(6)
    lines = [f"word {rng.randrange(99)} call +1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)} or "
             f"mail a{i}.b@mail{i % 9}.example.com from {rng.randrange(256)}.9.{rng.randrange(256)}.1 é" for i in range(300)]
    frame = spark.createDataFrame(list(enumerate([*lines, "(286) 555-5136 is it", None])), "doc_id long, text string")
    model = personal_data.fit(frame)
    out = {r.doc_id: r for r in personal_data.found(frame, model).collect()}
    for i, line in enumerate(lines):
        base = ",".join(f"{personal_data.KINDS[k]}:{a}:{b}" for a, k, b in base_by_pattern(line))
        assert out[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) <= set(out[i].spans.split(","))
    assert out[301].spans == "" and out[301].n_email == 0
    clean = {r.doc_id: r.text for r in personal_data.redacted(frame, model).collect()}
    assert clean[301] is None and all("@" not in t and "555" not in t for i, t in clean.items() if i < 300)
    assert personal_data.found(docs).count() == docs.count() and personal_data.found(none).count() == 0
    assert len(personal_data.base_spans("1" * 200_000 + "+" * 1000)) == 0


def test_grammar_weighs_context():
    grammar = automata.Grammar()
    target, insult, other = automata.TARGET, automata.INSULT, automata.OTHER
    assert grammar.scan([other, insult], [0, 2.0])[0] == 2
    assert grammar.scan([target, other, insult], [0, 0, 2.0])[1] == 2
    assert grammar.scan([automata.NEGATION, target, insult], [0, 0, 2.0])[2] == 2
    assert grammar.scan([automata.REPORT, *[other] * 9, insult], [0] * 10 + [1.0])[3] == 1
    assert grammar.scan([automata.REPORT, automata.NEGATION, automata.THREAT], [0, 0, 1.0])[9] == 1
    assert grammar.scan([target, *[other] * 6, insult], [0] * 7 + [1.0])[0] == 1


def test_toxicity(spark, docs, none):
    rng = random.Random(8)
    plain = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 8 == 0
        body = rng.choices(plain, k=60)
        for _ in range(3 * toxic):
            body[rng.randrange(60)] = rng.choice(["grumpkin", "blorbhead", "blorbface"])
        rows.append((i, " ".join(body) + ".", 1.0))
        labels.append((i, int(toxic)))
    frame = spark.createDataFrame([*rows, (None, None, 1.0), (900, "", 1.0), (901, LONG, 1.0)], "doc_id long, text string, score double")
    tags = spark.createDataFrame([*labels, (901, None), (None, 1)], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.judged(frame, tags).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(out[i].held_out == (i in set(held)) for i in range(400))
    assert all(out[i].predicted == int(i % 8 == 0) for i in held)
    assert out[900].predicted == 0 and 0 <= out[900].score <= 1 and out[901].predicted == 0
    assert {r.doc_id for r in toxicity.accepted(frame, tags).collect()} == {i for i in out if not out[i].predicted}
    assert toxicity.judged(docs, tags.limit(0)).count() == docs.count()
    assert toxicity.judged(none, tags.limit(0)).count() == 0


@given(st.lists(st.text(max_size=12), max_size=6))
@settings(max_examples=200, deadline=None)
def test_word_spans(texts):
    import pyarrow as pa
    found = []
    for _, _, data, at in spans.slices(pa.array(texts, pa.string()), limit=9):
        starts, ends, first = spans.word_spans(data, at)
        raw = data.tobytes()
        for k in range(len(at) - 1):
            found.append([raw[a:b].decode() for a, b in zip(starts[first[k]:first[k + 1]], ends[first[k]:first[k + 1]], strict=True)])
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    source = Path("/root/testdata/sf0.001")
    if not source.exists():
        pytest.skip("no test tables")
    docs = spark.read.parquet(str(source / "documents.parquet"))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, str(source))
        assert after.columns == docs.columns, name
        kept = spark.createDataFrame(after.collect(), docs.schema)
    texts = {r.doc_id: r.text for r in kept.collect()}
    _, root = brute_groups(texts, 5, 80)
    assert 0 < len(texts) < docs.count() and not any(personal_data.base_spans(t) for t in texts.values())
    assert len(set(root.values())) >= 0.98 * len(texts)  # redaction may bring two texts closer
    out = corpus_pipeline.STAGES[-1][1](spark, kept, str(source))
    assert {r.doc_id for r in out.select("doc_id").collect()} == set(texts)
