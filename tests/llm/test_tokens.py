"""Token ids, counts, packing, direct codes: against the libraries and by exact round trips."""

import array
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from beaconlog.llm import differencing, direct_codes, packing, token_counts, tokens

SYMBOLS = [
    "a", "B", "é", "É", " ", "  ", "   ", "\n", " \n", "\n\n", "\t", "'s", "'", "<|endoftext|>", "<|startoftext|>", "<s>", "1", "23",
    "!", "***", "\x1c", " ", "　", "İ", "ς", "Σ", "é", "漢字", "😀", ".", "<", "|>", "ß", "ﬁ", "_", "don't", "▁", "the",
    "ing", "THE", "====", "\x00", "<0x0A>", "́",
]


def mixed(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(SYMBOLS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def ids_of(raw):
    out = array.array("I")
    out.frombytes(raw)
    return list(out)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_the_library(texts, name):
    path = public_tokenizers.path(name)
    library, own = Tokenizer.from_file(path), tokens.encoder(path)
    for text in mixed(6000, 1) + list(texts.values()):
        assert ids_of(own.encode(text)) == library.encode(text, add_special_tokens=False).ids, text[:60]


def test_memo_turns_over(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), tokens.SpacePieces(path)
    monkeypatch.setattr(tokens, "MEMO_PIECES", 5)
    for text in mixed(500, 2) + ["and so on and so forth, and on and on"] * 2:
        assert ids_of(own.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_word_memo_is_bounded(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), tokens.WordPieces(path)
    monkeypatch.setattr(tokens, "WORD_PIECES", 5)
    long = "unforgettable," * 50
    for text in mixed(500, 5) + ["One word, two words; three (words) and more... ÀÉ école-école ÉCOLE", long] * 2:
        assert ids_of(own.encode(text)) == library.encode(text, add_special_tokens=False).ids
        # words and their marks are held once, and nothing else is remembered
        held = [own, *(d for d in vars(own).values() if isinstance(d, dict) and d is not own.bytes)]
        assert sum(map(len, held)) <= 2 * 5
    assert long not in own and long not in own.old


@pytest.fixture(scope="module")
def transducer():
    return token_counts.compile_model(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.mark.parametrize("chunk", [1, 5, 1 << 16])
def test_counts_equal_the_library(texts, transducer, library, chunk):
    for text in mixed(4000, 3) + list(texts.values())[:30]:
        assert transducer.count(text, chunk) == len(library.encode(text)), text[:60]


def test_states_are_rebuilt(library):
    small = token_counts.compile_model(public_tokenizers.path("piece_bpe_32k.model"))
    small.max_states = 50
    for text in mixed(300, 4) + ["an unthinkably extraordinary internationalization"]:
        assert small.count(text, 64) == len(library.encode(text))


def test_chunk_maps_are_associative(transducer):
    parts = [transducer.chunk(p.replace(" ", "▁")) for p in ("▁ab", "c de", "f", "\n", "gh ij\nk", " l")]
    left = right = parts[0]
    for p in parts[1:]:
        left = transducer.compose(left, p)
    right = parts[-1]
    for p in reversed(parts[:-1]):
        right = transducer.compose(p, right)
    assert left == right


def test_token_counts(spark, odd_docs, no_docs, library):
    got = token_counts.count_tokens(odd_docs, public_tokenizers.path("piece_bpe_32k.model"), limit=100, chunk_chars=1000).collect()
    want = []
    for r in odd_docs.collect():
        n = len(library.encode(r.text or ""))
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 100))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert token_counts.count_tokens(no_docs, public_tokenizers.path("piece_bpe_32k.model")).count() == 0


# ── packing ─────────────────────────────────────────────────────────────────

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(50, 80))
def test_windows_hold_everything(sizes, capacity):
    of = differencing.into_windows(np.array(sizes, "int64"), capacity)
    assert len(of) == len(sizes)
    if sizes:
        assert np.bincount(of, weights=sizes).max() <= capacity


def test_differencing_is_near_equal():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 1025, 3000)
    of = differencing.difference(sizes, 300)
    sums = np.bincount(of, weights=sizes, minlength=300)
    assert sums.sum() == sizes.sum() and np.ptp(sums) <= 0.02 * sums.mean()
    assert differencing.into_windows(sizes, 4096).max() + 1 <= 1.02 * sizes.sum() / 4096
    with pytest.raises(ValueError):
        differencing.into_windows(np.array([5]), 4)


@pytest.mark.parametrize("block", [500, 1 << 21])
def test_packing(spark, odd_docs, no_docs, block):
    path, capacity = public_tokenizers.path("word_bpe_49k.json"), 256
    got = packing.pack_windows(odd_docs.repartition(3), path, 2, capacity=capacity, block_tokens=block).toPandas()
    library = Tokenizer.from_file(path)
    want = sorted((repr(r.doc_id), tuple(library.encode(r.text or "", add_special_tokens=False).ids + [2])) for r in odd_docs.collect())
    # pieces of one row follow one another; rows with tied ids are told apart by their ids' order
    assert sum(got["length"]) == sum(len(ids) for _, ids in want)
    single = {i: ids for i, ids in want if sum(j == i for j, _ in want) == 1}
    for i, ids in single.items():
        own = got[got["doc_id"].map(lambda x: repr(int(x)) if x == x else "None") == i].sort_values("start")
        assert ids_of(b"".join(own["ids"])) == list(ids)
        assert list(own["start"]) == list(np.cumsum(own["length"]) - own["length"])
    for _, window in got.sort_values("offset").groupby("sequence_id"):
        assert list(window["offset"]) == list(np.cumsum(window["length"]) - window["length"])
        assert window["length"].sum() <= capacity
    assert got["sequence_id"].nunique() == got["sequence_id"].max() + 1
    assert packing.pack_windows(no_docs, path, 2).count() == 0


# ── directly addressable codes ──────────────────────────────────────────────

@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500))
def test_codes_round_trip(ids):
    values = np.array(ids, "u4")
    cut = sorted({0, len(ids) // 3, len(ids)})
    segment = direct_codes.Segment(direct_codes.pack(values, np.array(cut)))
    assert segment.tokens().tolist() == ids
    assert segment.offsets.tolist() == cut
    for p in range(0, len(ids), 7):
        assert segment.token(p) == ids[p]


def test_write_and_read_codes(spark, odd_docs, no_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    segments = direct_codes.write_codes(odd_docs, path, 0, segment_ids=100)
    got = sorted(map(tuple, direct_codes.read_documents(segments).collect()), key=lambda r: r[1])
    library = Tokenizer.from_file(path)
    docs = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids + [0]) for r in odd_docs.collect()]
    assert [r[0] for r in got] == sorted((i for i, _ in docs), key=lambda i: (i is not None, i or 0))
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
    crc = lambda ids: zlib.crc32(array.array("I", ids).tobytes())
    assert sorted((repr(i), n, c) for i, _, n, c in got) == sorted((repr(i), len(x), crc(x)) for i, x in docs)
    order = [x for i, _, n, c in got for j, x in docs if (j, len(x), crc(x)) == (i, n, c)]
    flat = [t for x in order[:1] for t in x]
    assert [r.token for r in direct_codes.read_tokens(segments, list(range(len(flat)))).orderBy("position").collect()] == flat
    assert direct_codes.read_documents(direct_codes.write_codes(no_docs, path, 0)).count() == 0


def test_worker_remembers_one_step_at_a_time():
    from beaconlog.llm.common import worker_memo

    first = worker_memo("one step")
    first["word"] = 1
    assert worker_memo("one step") is first
    assert worker_memo("next step") == {} and worker_memo("one step") == {}


def test_quality_step_lets_go_of_the_words_before():
    import pyarrow as pa

    from beaconlog.llm import quality_rank
    from beaconlog.llm.common import worker_memo

    words = worker_memo("tokens")
    words["word"] = 1
    assert quality_rank._measured(pa.array(["one text", None])).shape == (2, len(quality_rank.FEATURES))
    assert worker_memo("tokens") == {} and worker_memo("tokens") is not words
