"""Operators on inputs where less than the whole job used to be done."""
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql.group import GroupedData

from ledgermill.llm import byte_bpe, kneser_ney, packing, personal_data, pieces, spans, token_counts, topk
from ledgermill.llm.byte_bpe import vocabulary_path


def test_top_k_groups_have_a_bound(spark, monkeypatch):
    rng = np.random.default_rng(9)
    data = rng.integers(-50, 50, (6000, 8))
    rows = spark.createDataFrame([(i, v.astype(float).tolist()) for i, v in enumerate(data)], "vec_id long, v array<double>")
    plain, bound = GroupedData.applyInArrow, 4 * 8192

    def watched(self, work, schema):
        def measured(table):
            if table.nbytes > bound:
                raise ValueError(f"a group of {table.nbytes} bytes")
            return work(table)
        return plain(self, measured, schema)

    monkeypatch.setattr(GroupedData, "applyInArrow", watched)
    monkeypatch.setattr(topk.top_k, "__defaults__", tuple(
        8192 if x == getattr(topk, "STRIPE_BYTES", None) else x for x in topk.top_k.__defaults__))
    out = topk.top_k(rows, rows.where("vec_id < 40"), k=3, block=16, query_block=25).collect()
    scores = data[:40] @ data.T
    for q in range(40):
        want = sorted((-int(s), i) for i, s in enumerate(scores[q]) if i != q)[:3]
        assert [(-r.score, r.vec_id) for r in sorted((r for r in out if r.query_id == q), key=lambda r: r["rank"])] == want


def test_added_tokens_have_one_id(spark):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a{end}b", end, end * 3, f"  x  {end}  y \n{end}\n", f"it{end}'s <|endof", f"text|> {end[:-1]} <{end}>",
             f"odd\x0b  space {end}  \x0b z", f"é {end}é", f"{end} word " * 700, "without"]
    assert model.encode(texts[0], add_special_tokens=False).ids == [64, 50256, 65]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    ids = [model.encode(t, add_special_tokens=False).ids for t in texts]
    out = packing.pieces(docs, with_ids=True).collect()
    for i, want in enumerate(ids):
        parts = sorted((r for r in out if r.doc_id == i), key=lambda r: r.start)
        assert sum((r.ids for r in parts), []) == [*want, packing.END_ID]
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) for r in parts)
    assert {r.doc_id: r.length for r in token_counts.document_lengths(docs).collect()} == dict(enumerate(map(len, ids)))


def test_rare_kinds_have_examples_in_a_large_table(spark):
    rng = random.Random(11)
    lines = [f"word {rng.randrange(99)} mail a{i}.b@mail{i % 9}.example.com now" for i in range(3000)]
    for i in range(0, 3000, 50):
        lines[i] = f"host {rng.randrange(100, 256)}.{rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(256)} is up"
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    for limit in (personal_data.EXAMPLES, 400):
        rows = personal_data.examples(docs, sample=100, limit=limit).collect()
        assert len(rows) <= limit and sum(r.x[1] == 1 and r.y == 1 for r in rows) >= 100
    assert 1 in personal_data.fit(docs, sample=100).thresholds


def test_driver_gets_one_row_per_frequent_word(spark, monkeypatch):
    rng = random.Random(4)
    lines = [" ".join(rng.choices([f"w{i}" for i in range(25)], [9, 9, *[1] * 23], k=rng.randrange(1, 12))) for _ in range(200)]
    docs = spark.createDataFrame([(x,) for x in lines], "text string")
    plain, met = type(docs).collect, []

    def watched(self):
        rows = plain(self)
        met.extend(r["context"] for r in rows if "context" in r.__fields__ and r["context"] >= 0)
        return rows

    monkeypatch.setattr(type(docs), "collect", watched)
    model = kneser_ney.train(docs, parts=4)
    assert len(met) == len(set(met)) > 1 and set(met) <= set(model.hot)
    pairs = [(a, b) for x in lines for a, b in zip([None, *x.split()], [*x.split(), None], strict=True)]
    starts = {b for a, b in pairs if a is None}
    begin = model.hot_stats[model.hot.index(model.size)]
    assert begin[0] == len(lines) and sum(begin[1:]) == len(starts) and model.bigrams == len(set(pairs))


def thue_morse(n, a, b):
    """Words that polynomial hashes modulo powers of two cannot tell from their complements."""
    word = a
    while len(word) < n:
        word += word.translate(str.maketrans(a + b, b + a))
    return word


ODD = ["\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", "\u1680", "\u2000", "\u2009", "\u200a", "\u2028", "\u202f", "\u205f", "\u3000",
       "\u200b", "\ufeff", " ", " ", " ", "\n", "\r\n", "\t", "a", "bc", "É", "1", "!", "'s", "。", "<|endoftext|>"]


def byte_ids(texts):
    out = []
    for _, _, first, chunks, entries in byte_bpe.encoded(pa.array(texts, pa.string()), vocabulary_path()):
        ids, at = chunks.ids(entries).tolist(), 0
        for n in byte_bpe.totals(chunks.counts(entries), first).tolist():
            out.append(ids[at:at + n])
            at += n
    return out


def test_ids_of_constructed_words_and_odd_white_space(monkeypatch):
    import sentencepiece
    from tokenizers import Tokenizer
    rng = random.Random(1)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(14))) for _ in range(3000)]
    texts += [x for n in (64, 512, 1024, 2048, 4096) for x in (thue_morse(n, "a", "b"), thue_morse(n, "b", "a"))]
    texts += ["plain words\u00a0with one odd blank " * 30_000]
    model = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    want = [x.ids for x in model.encode_batch(texts, add_special_tokens=False)]
    assert byte_ids(texts) == want
    # hashes that hardly tell chunks apart must not matter, nor a table that is emptied all the time
    monkeypatch.setattr(spans, "span_hashes", lambda data, starts, ends, lower=False: ((ends - starts) % 3).astype(np.uint64))
    monkeypatch.setattr(byte_bpe, "_tables", {})
    byte_bpe.chunk_table(vocabulary_path()).limit = 3000
    assert byte_ids(texts[:400] + texts[-11:-1]) == want[:400] + want[-11:-1]
    chunks = pieces.PieceChunks(vocabulary_path("piece_bpe_32k.model"))
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    words = [b" " + x.encode() for x in [*texts[-11:-1], "one", "two", "six"]]
    data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
    entries = chunks.positions(data, ends - np.array([len(w) for w in words]), ends)
    assert chunks.ids(entries).tolist() == [i for w in words for i in library.encode(w[1:].decode())]


def test_one_odd_blank_does_not_fill_the_table():
    texts = [f"word{i % 50} here\u00a0and there " * 20 + f"end {i}" for i in range(2000)]
    byte_bpe._tables.clear()
    byte_ids(texts)
    table = byte_bpe.chunk_table(vocabulary_path())
    assert table.n.size < 3000 and table._bytes() < 500_000


def test_hashes_tell_constructed_spans_apart():
    words = [x.encode() for n in (8, 64, 256, 512, 1024, 4096) for x in (thue_morse(n, "a", "b"), thue_morse(n, "b", "a"))]
    words += [b"a" * n for n in range(1, 40)] + [b"\x00" * n for n in range(1, 20)] + [b"x" * 513, b"x" * 512]
    data, n = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
    ends = np.cumsum(n)
    hashes = spans.span_hashes(data, ends - n, ends)
    assert len(set(hashes.tolist())) == len(words)
    for k, w in enumerate(words):
        assert spans.span_hashes(np.frombuffer(w.upper(), np.uint8), np.array([0]), np.array([len(w)]), lower=True)[0] == hashes[k]


def test_a_very_long_text(spark):
    """One text of 8 MB among short ones: ids as the library has them, pieces within their length."""
    from tokenizers import Tokenizer
    text = " ".join(f"word{i % 7919}" for i in range(900_000))
    docs = spark.createDataFrame([(1, text), (2, "short"), (3, None)], "doc_id long, text string")
    ids = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids + [packing.END_ID]
    out = packing.pack_documents(docs).where("doc_id = 1").orderBy("start").collect()
    assert sum(r.length for r in out) == len(ids) and max(r.length for r in out) <= 1024
    for r in out[:: len(out) // 50]:
        assert zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    one = {r.doc_id: r for r in pieces.encode_documents(docs).collect()}[1]
    assert one.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_near_copies_under_repeated_ids(spark):
    import corpus_pipeline
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(5, a), (5, b), (9, b), (3, a), (7, c), (7, c), (None, a), (8, ""), (8, None)]
    docs = spark.createDataFrame([(*r, "en", "s", 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars int")
    out = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert {t for i, t in out if i is not None} - {None, ""} == {a, b, c} and (None, a) in out
    assert sorted(t[0] for i, t in out if i is not None and t) == ["a", "b", "c"] and sum(i == 7 for i, _ in out) == 1


def test_repeated_ids_are_linked_by_all_their_texts(spark):
    from ledgermill.llm import hyper_minhash
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(5, a), (5, b), (9, b + " more"), (3, a), (7, c), (7, c), (8, "one"), (8, "two"), (8, None), (None, a), (None, b)]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, n_shingles string")
    out = hyper_minhash.near_duplicates(docs, words=2).collect()
    assert len(out) == len(rows)
    want = {3: 3, 5: 3, 9: 3, 7: 7, 8: 8, None: None}
    assert all(r.component_id == want[r.doc_id] and r.kept == (r.doc_id is not None and r.doc_id == want[r.doc_id]) for r in out)
    assert sorted(r.n_shingles for r in out if r.doc_id == 5) == [59, 59] and sorted(
        r.n_shingles for r in out if r.doc_id == 8) == [0, 1, 1]


def test_mapped_arrays_have_a_bound(tmp_path, monkeypatch):
    monkeypatch.setattr(kneser_ney, "_room", lambda: 5)
    kneser_ney._mapped.clear()
    for i in range(20):
        kneser_ney._save(str(tmp_path), f"x-{i}", np.full(3, i))
    for _ in range(2):
        assert [int(kneser_ney._load(str(tmp_path), f"x-{i}")[1]) for i in range(20)] == list(range(20))
        assert len(kneser_ney._mapped) == 5


def test_scores_against_plain_kneser_ney(spark):
    """Interpolated modified Kneser-Ney bigrams by the definition, from counts in dictionaries."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.6, int(rng.integers(0, 30))) if x < 60) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in kneser_ney.scored(docs).collect()}
    pairs = Counter()
    for i, t in enumerate(texts):
        if not out[i].held_out:
            tokens = ["<", *t.split(), ">"]
            pairs.update(zip(tokens, tokens[1:], strict=False))
    before = Counter(w for _, w in pairs)
    total, kinds = Counter(), {}
    for (h, _), n in pairs.items():
        total[h] += n
        kinds.setdefault(h, Counter())[min(n, 3)] += 1

    def discounts(counts):
        n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
        if not min(n):
            return [0.0, 0.5, 1.0, 1.5]
        y = n[0] / (n[0] + 2 * n[1])
        return [0.0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.01), k - 0.01) for k in (1, 2, 3)]

    d2, d1 = discounts(pairs.values()), discounts(before.values())
    left1 = sum(d1[min(n, 3)] for n in before.values()) / len(pairs)

    def p(h, w):
        low = max(before[w] - d1[min(before[w], 3)], 0) / len(pairs) + left1 / (len(before) + 1)
        if not total[h]:
            return low
        n = pairs[h, w]
        share = sum(d2[k] * c for k, c in kinds[h].items()) / total[h]
        return max(n - d2[min(n, 3)], 0) / total[h] + share * low

    for i, t in enumerate(texts):
        tokens = ["<", *t.split(), ">"]
        want = sum(np.log10(p(h, w)) for h, w in zip(tokens, tokens[1:], strict=False))
        assert abs(out[i].score - want) < 1e-8 * max(1, abs(want))
