"""Token counts, grammar files and packing against plain encoding with the libraries."""

import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from fieldlens.llm import packing, repair_grammar, token_counts  # noqa: E402
from fieldlens.llm.tokens import encoder  # noqa: E402

ODD = [None, "", " ", "\n\n x", "a  b   c", "<|endoftext|> is <|startoftext|>x", "it's we'll  don't", "日本語 テスト　全角", "é é", "same", "same",
       "word " * 9000 + "end", "x" * 40_000, ("The erst ing, of " * 60 + "\n") * 60]


@lru_cache
def library(name):
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(name))


def ids(name, text):
    return library(name).encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)]
    rows += [(100 + i, " ".join(f"w{(i * k) % 97} thing." for k in range(i * 7 % 300)), "y") for i in range(120)]
    return spark.createDataFrame(rows, "doc_id long, text string, uid string").repartition(5)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_give_the_ids_of_the_text(name):
    got = encoder(name).encode([t or "" for t in ODD])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [ids(name, t) for t in ODD]


def test_counts(spark, docs):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.op4(docs).collect()}
    want = {r.doc_id: (len((r.text or "").encode()), len(ids("word_bpe_49k.json", r.text))) for r in docs.collect()}
    assert got == {k: (b, n, n > 2048) for k, (b, n) in want.items()}


def test_overlaps_widen(spark):
    rows = [(1, "ab cd " * 200), (2, "z" * 900), (3, "q" * 700 + " tail" * 90)]
    df = spark.createDataFrame(rows, "uid long, text string")
    got = {r.uid: r.n_tokens for r in token_counts.count_tokens(df, "byte_bpe_50k.json", chunk=64, overlap=16).collect()}
    assert got == {i: len(ids("byte_bpe_50k.json", t)) for i, t in rows}


def test_grammar_files(spark, docs):
    got = sorted(tuple(r) for r in repair_grammar.op5(docs).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    want, at = [], 0
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        x = [*ids("byte_bpe_50k.json", r.text), 2]
        want.append((r.doc_id, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        at += len(x)
    assert got == want


def test_grammar_shrinks_and_expands():
    rng = np.random.default_rng(1)
    counts = rng.integers(1, 60, 400)
    raw = rng.choice(40, counts.sum(), p=np.arange(1, 41) / 820)
    seq, symbols, left, right, size = repair_grammar.compress(raw, counts, first=40, pairs=8, rounds=6)
    assert len(seq) < 0.95 * len(raw) and symbols.sum() == len(seq) and len(symbols) == len(counts)
    assert (repair_grammar.expand(seq, left, right, size, 40) == raw).all()
    one = slice(symbols[:5].sum(), symbols[:6].sum())
    assert (repair_grammar.expand(seq[one], left, right, size, 40) == raw[counts[:5].sum():counts[:6].sum()]).all()


def neighbours(doc):
    """Pairs of a document; in a run of one symbol every other one counts."""
    seen, before = [], None
    for p in zip(doc, doc[1:]):
        before = None if p == before and p[0] == p[1] else p
        seen += [p] if before else []
    return seen


def replaced(doc, pair, symbol):
    out, i = [], 0
    while i < len(doc):
        hit = tuple(doc[i:i + 2]) == pair
        out.append(symbol if hit else doc[i])
        i += 2 if hit else 1
    return out


@pytest.mark.parametrize("kinds,seed", [(3, 1), (12, 2), (60, 3)])
def test_grammar_goes_on_until_no_pair_repeats(kinds, seed):
    rng = np.random.default_rng(seed)
    passage = rng.integers(0, kinds, 70).tolist()
    docs = [rng.integers(0, kinds, n).tolist() for n in rng.integers(1, 40, 25)] + [passage, [0] * 37 + passage, [1] * 8, [1] * 9 + [2], [0]]
    raw, counts = np.concatenate(docs), np.array([len(d) for d in docs])
    seq, symbols, left, right, size = repair_grammar.compress(raw, counts, first=kinds)
    # Plain Re-Pair: every rule is of a most frequent pair, and the last one leaves none that occurs twice.
    for symbol, pair in enumerate(zip(left.tolist(), right.tolist()), kinds):
        often = Counter(p for d in docs for p in neighbours(d))
        assert often[pair] == max(often.values()) >= 2
        docs = [replaced(d, pair, symbol) for d in docs]
    assert max(Counter(p for d in docs for p in neighbours(d)).values()) == 1
    assert seq.tolist() == [s for d in docs for s in d] and symbols.tolist() == [len(d) for d in docs]
    assert (repair_grammar.expand(seq, left, right, size, kinds) == raw).all() and size.tolist() == [
        len(repair_grammar.expand(np.array([kinds + k]), left, right, size, kinds)) for k in range(len(left))]


def test_grammar_of_nothing_and_of_single_ids():
    for raw, counts in ([], []), ([5], [1]), ([5, 5], [1, 1]), ([5, 5], [2]):
        seq, symbols, left, right, size = repair_grammar.compress(np.array(raw, int), np.array(counts, int))
        assert seq.tolist() == raw and symbols.tolist() == counts and len(left) == len(right) == len(size) == 0
        assert repair_grammar.expand(seq, left, right, size).tolist() == raw


def test_packing(spark, docs):
    rows = packing.op9(docs, capacity=512).collect()
    by_doc, by_bin = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_bin.setdefault(r.sequence_id, []).append(r)
    total = 0
    for r in docs.collect():
        x, parts = [*ids("word_bpe_49k.json", r.text), 1], sorted(by_doc[r.doc_id], key=lambda p: p.piece)
        total += len(x)
        assert [p.start for p in parts] == list(range(0, len(x), 512)) and sum(p.length for p in parts) == len(x)
        assert all(p.ids_crc32 == zlib.crc32(np.array(x[p.start:p.start + p.length], "<u4").tobytes()) for p in parts)
    for parts in by_bin.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 512
    assert len(by_bin) <= -(-total // 512) * 1.02 + 1


def test_empty_tables(spark, docs):
    none = docs.filter("false")
    assert token_counts.op4(none).count() == repair_grammar.op5(none).count() == packing.op9(none).count() == 0


@pytest.mark.parametrize("length,each", [(2500, 1), (1500, 2)])
def test_groups_stay_bounded(spark, length, each):
    items = spark.range(1500).selectExpr("id AS uid", f"cast({length} AS long) AS length")
    rows = packing.pack(items, 4096, group_size=64).collect()
    groups, bins = {}, {}
    for r in rows:
        groups[r.sequence_id >> 20] = groups.get(r.sequence_id >> 20, 0) + 1
        bins.setdefault(r.sequence_id, []).append(r.offset)
    assert sorted(r.uid for r in rows) == list(range(1500)) and max(groups.values()) < 200
    assert all(sorted(o) == [length * k for k in range(len(o))] and len(o) <= each for o in bins.values()) and len(bins) <= 1500 / each + 24


def test_texts_are_encoded_together():
    """Each distinct pre-token of a call goes to the library once, whatever texts and words it stands in."""
    import pyarrow as pa

    from fieldlens.llm.tokens import WordEncoder
    name = "byte_bpe_50k.json"
    enc, asked = WordEncoder(name), []
    tokenize = enc.tokenize
    enc.tokenize = lambda s: asked.append(s) or tokenize(s)
    texts = [*ODD, *(f"The erst{k} ing, of\nthe {'erst ' * (k % 3)}end." for k in range(200)), "Straße ÷ übermäßig naïve’s", "tail\x85", "a\x0bb  c", "don't\tgo 12 345"]
    got, n = enc.listed(pa.array(["skipped", *texts]).slice(1))
    want = [ids(name, t) for t in texts]
    assert n.tolist() == [len(w) for w in want] and got.tolist() == [i for w in want for i in w]
    asked.clear()
    enc.parts.clear()
    enc.parts.old = {}
    enc.listed(pa.array([f"word end{k % 7}, word" for k in range(500)]))
    assert len(asked) == len(set(asked)) < 15
