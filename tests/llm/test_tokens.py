"""Token counts and packing against the library on whole texts."""

import zlib
from functools import lru_cache
from unicodedata import normalize

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.edge import SCHEMA, clashing, edge_documents
from wicketworks.llm import pieces
from wicketworks.llm.packing import pack, plan_best_fit
from wicketworks.llm.token_counts import count_tokens

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = st.lists(st.sampled_from([*"abZé ß's.,!19\n\t\r\x1c\x1f\x01\x85  ́Σσ語<|>", " ", "\n", "'ll", "<|endoftext|>"]), max_size=40).map("".join)


whole = lru_cache(Tokenizer.from_file)


@settings(max_examples=400, deadline=None)
@given(st.lists(ODD, max_size=4))
@pytest.mark.parametrize("path,kind", [(BYTES, "spaced"), (WORDS, "words")])
def test_pieces_give_the_ids_of_whole_texts(path, kind, texts):
    library = whole(path)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(b"".join(v), "<u4").tolist() for v in pieces.encoder(path, kind).encode(texts)]
    assert got == want


@settings(max_examples=400, deadline=None)
@given(st.lists(ODD, max_size=6))
def test_short_pieces_give_the_ids_of_whole_texts(texts):
    want = [e.ids for e in whole(BYTES).encode_batch(texts, add_special_tokens=False)]
    library = pieces.encoder(BYTES, "short")
    assert [np.frombuffer(b"".join(v), "<u2").tolist() for v in library.encode(texts)] == want
    library.memo = pieces._Memo()  # what is new is encoded with other pieces around it
    assert [np.frombuffer(b"".join(v), "<u2").tolist() for v in library.encode(texts[::-1])] == want[::-1]


def test_short_pieces_behind_any_letter_and_many_to_a_text(monkeypatch):
    """Each letter with marks around it, line feeds and blanks; new pieces reach the library many to a text."""
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha() and (ord(c) < 0x3400 or 0xA000 <= ord(c) < 0xAC00 or 0xD7A4 <= ord(c) < 0x20000)]
    texts = [f"{c}, !{c}?\n{c}1 <|endoftext|>\n {c}'s\n\n({c}) -\u00a0{c}  {c}" for c in letters]
    want = [e.ids for e in whole(BYTES).encode_batch(texts, add_special_tokens=False)]
    library = pieces.encoder(BYTES, "short")
    library.memo = pieces._Memo()
    sent, plain = [], library.library
    monkeypatch.setattr(library, "library", type("Counting", (), {"encode_batch_fast": staticmethod(lambda x, **k: sent.append(len(x)) or plain.encode_batch_fast(x, **k))}))
    got = [np.frombuffer(b"".join(v), "<u2").tolist() for v in library.encode(texts)]
    assert [t for t, x, y in zip(texts, got, want) if x != y] == []
    library.memo = pieces._Memo()
    sent.clear()
    list(library.encode([" ".join(f"new{i}" for i in range(2560))]))
    assert sum(sent) <= 12


PLAIN = [c for c in map(chr, range(0x100)) if c.isalpha() and c not in "\u00aa\u00b5\u00ba"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*PLAIN, *"  \n.,;:!?#$%&*'"]), max_size=80).map("".join), max_size=4))
@pytest.mark.parametrize("path,kind", [(BYTES, "spaced"), (BYTES, "short"), (WORDS, "words")])
def test_plain_words_and_marks(path, kind, texts):
    want = [e.ids for e in whole(path).encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(b"".join(v), "<u2" if kind == "short" else "<u4").tolist() for v in pieces.encoder(path, kind).encode(texts)]
    assert got == want


@pytest.mark.parametrize("path,kind", [(BYTES, "short"), (WORDS, "words")])
def test_plain_words_are_encoded_by_the_model_alone(monkeypatch, path, kind):
    """Only what is no plain word reaches the whole library, whatever stands behind a word."""
    texts = [" ".join(f"{a}{b}{c}" + (".", "", ",***")[i % 3] for i, c in enumerate(PLAIN)) for a in "aéZÿ" for b in PLAIN] + ["x1 2"]
    want = [e.ids for e in whole(path).encode_batch(texts, add_special_tokens=False)]
    library = pieces.encoder(path, kind)
    library.memo = pieces._Memo()
    sent, plain = [], library.library
    monkeypatch.setattr(library, "library", type("Counting", (), {"encode_batch_fast": staticmethod(lambda x, **k: sent.extend(x) or plain.encode_batch_fast(x, **k))}))
    got = [np.frombuffer(b"".join(v), "<u2" if kind == "short" else "<u4").tolist() for v in library.encode(texts)]
    assert got == want
    assert len(sent) <= 4 and not any(c.isalpha() for t in sent for c in t.replace("x1", ""))


def test_an_added_token_of_letters_is_no_plain_word(tmp_path):
    library = Tokenizer.from_file(BYTES)
    library.add_tokens(["ing"])
    library.save(str(tmp_path / "t.json"))
    one = pieces.PieceEncoder(str(tmp_path / "t.json"), pieces.spaced_pieces, list)
    assert [sum(v, []) for v in one.encode(["singing ing."])] == [library.encode("singing ing.").ids]


# Letters that NFC or lower-casing turns into a letter and a mark.
SPLIT = [c for c in map(chr, range(0x110000)) if c.isalpha() and len(normalize("NFC", normalize("NFC", c).lower())) > 1]


@pytest.mark.parametrize("path,kind", [(BYTES, "spaced"), (WORDS, "words")])
def test_closing_punctuation_behind_any_letter(path, kind):
    """Every letter with every closing mark, alone and behind another letter; each in a fresh memo."""
    assert len(SPLIT) >= 60
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha() and (ord(c) < 0x3400 or 0xA000 <= ord(c) < 0xAC00 or 0xD7A4 <= ord(c) < 0x20000)]
    texts = [c + p for c in letters for p in ".,;:!?"] + [f"a{c}{p} b" for c in SPLIT for p in (".", "?!")]
    want = [e.ids for e in whole(path).encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(b"".join(v), "<u4").tolist() for v in pieces.encoder(path, kind).encode(texts)]
    assert [t for t, x, y in zip(texts, got, want) if x != y] == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*SPLIT, *"aσ \u0301.,;:!?'"]), max_size=20).map("".join), max_size=4))
@pytest.mark.parametrize("path,kind", [(BYTES, "spaced"), (WORDS, "words")])
def test_pieces_of_split_letters(path, kind, texts):
    want = [e.ids for e in whole(path).encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(b"".join(v), "<u4").tolist() for v in pieces.encoder(path, kind).encode(texts)]
    assert got == want


def test_memo_is_bounded_and_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "MEMO_PIECES", 3)
    one = pieces.PieceEncoder(BYTES, pieces.spaced_pieces, len)
    texts = ["a b c d", "b c e", "a f " + "y" * 500]
    library = Tokenizer.from_file(BYTES)
    for text in texts * 2:
        assert [sum(v) for v in one.encode([text])] == [len(library.encode(text).ids)]
        assert all(len(p) <= pieces.MEMO_CHARS for p in one.memo)


def test_counts_on_edge_rows(spark):
    docs = edge_documents(spark)
    library = Tokenizer.from_file(BYTES)
    want = sorted(
        (str(r.doc_id), len((r.text or "").encode()), n := len(library.encode(r.text or "").ids), n > 1024) for r in docs.collect()
    )
    for df in (docs, clashing(docs)):
        got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(df, BYTES).collect())
        assert got == want
    assert count_tokens(spark.createDataFrame([], SCHEMA), BYTES).count() == 0


def check_packing(docs, packed, capacity):
    library = Tokenizer.from_file(WORDS)
    want = []
    for r in docs:
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        for i, at in enumerate(range(0, len(ids), capacity)):
            one = ids[at : at + capacity]
            want.append((str(r.doc_id), i, at, len(one), zlib.crc32(one.tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in packed) == sorted(want)
    sequences = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity,buckets", [(2048, None), (8, 3)])
def test_packing_on_edge_rows(spark, capacity, buckets):
    docs = edge_documents(spark)
    rows = docs.collect()
    for df in (docs, clashing(docs)):
        packed = pack(df, WORDS, capacity, buckets=buckets).collect()
        used = check_packing(rows, packed, capacity)
        assert used <= 1.3 * sum(r.length for r in packed) / capacity + 1
    assert pack(spark.createDataFrame([], SCHEMA), WORDS).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=30))
def test_plan_is_best_fit_decreasing(counts):
    capacity = 50
    steps, sequences = plan_best_fit(counts, capacity)
    rooms = []  # one by one
    for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fitting = [r for r in rooms if r >= length]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - length)
        else:
            rooms.append(capacity - length)
    assert sequences == len(rooms)
    assert sum(counts.values()) == 0 or {s.length for s in steps} == set(counts)
