"""Encoding long texts piece by piece.

Public tokenizers split a text into words before they merge, so a text can be cut where a
word must begin and the pieces encoded one by one. A piece of plain letters is encoded by the
library's model where it is first met, the other distinct pieces of a batch together by the whole
library; a bounded memo keeps them for the next batch of the same worker. The ids of a text are the ids of its pieces in order, exactly as if the
library had encoded the whole text (tests compare both).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from operator import attrgetter
from unicodedata import normalize

# Entries of a worker's memo, and the longest piece kept there: at most some 150 MB.
MEMO_PIECES = 600_000
MEMO_CHARS = 64

# The regular expressions of the tokenizers do not count U+001C to U+001F as white space; Python does.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_OTHER_SPACE = "\x00\t\v\f\r\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_UNUSUAL = ("  ", "\n\n", " \n", "\n ", *_SEPARATORS, *_OTHER_SPACE)
_RUNS = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
_WORDS = re.compile(r"[\S\x1c-\x1f]+")
_CLOSING = ".,;:!?"
# Pieces that are encoded as one text, and what stands between them: where white space is dropped a character that is a
# token, where it is kept a line feed, which leaves a piece that has one blank at most, in front, as it is alone.
JOINED_PIECES = 256
_BETWEEN_BARE = " \x01 "
_BETWEEN_SPACED = "\n"
_ONE_WORD = re.compile(r" ?\S+")
# Letters that NFC leaves as they are and that lower-casing turns into one letter: a piece of them alone is one word, which
# the library's model encodes without the steps before it. ASCII marks behind such a word, up to white space, are a word too.
_PLAIN_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_MARKS = ".,;:!?#$%&*"
_PLAIN = re.compile(f"( ?[{_PLAIN_LETTERS}]+)([{_MARKS}]*)")
_PLAIN_CHARS = re.compile(f"[ {_PLAIN_LETTERS}{_MARKS}]+")


@lru_cache(maxsize=1 << 14)
def _stays_letter(c: str) -> bool:
    """Whether a letter is one letter still after NFC and lower-casing, so that no mark of it joins punctuation behind it."""
    plain = c if c.isascii() else normalize("NFC", normalize("NFC", c).lower())
    return len(plain) == 1 and plain.isalpha()


def spaced_pieces(text: str) -> list[str]:
    """Cut before every run of white space: right for tokenizers that keep white space.

    In a text whose white space is single blanks and line feeds, a line feed is a token by itself.
    """
    if any(c in text for c in _UNUSUAL):
        return _RUNS.findall(text)
    return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")


def bare_pieces(text: str) -> list[str]:
    """The runs without white space: right for tokenizers that drop white space."""
    return _WORDS.findall(text) if any(c in text for c in _SEPARATORS) else text.split()


class _Memo(dict):
    """Values of pieces; an unknown piece is encoded at once if it can be, else noted once."""

    def __init__(self, at_once: Callable[[str], object] = lambda piece: None) -> None:
        super().__init__()
        self.unknown: list[str] = []
        self.at_once = at_once

    def __missing__(self, piece: str) -> object:
        value = self.at_once(piece)
        if value is None:
            self.unknown.append(piece)
        self[piece] = value
        return value


class PieceEncoder:
    """Encodes texts through their pieces; ``value`` turns a piece's ids into what is kept.

    With ``joined``, many pieces are encoded as one text with it between them.
    """

    def __init__(self, path: str, split: Callable[[str], list[str]], value: Callable[[list[int]], object], joined: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.model = self.library.model
        self.split = split
        self.value = value
        self.memo = _Memo()
        self.joined = joined
        mark = self.library.encode(joined, add_special_tokens=False).ids if joined else []
        self.between = mark[0] if len(mark) == 1 else None
        self.lower, self.bytes = False, {}
        self.direct = self._learn_words()

    def _learn_words(self) -> bool:
        """Whether the model alone gives plain words the ids that the whole library gives them; ``lower`` and ``bytes`` say in
        what form it must get them. Each letter is tried alone, behind and before others, and all in one word. A token added to
        the model that may stand in such a word rules it out."""
        from tokenizers.pre_tokenizers import ByteLevel

        if any(_PLAIN_CHARS.fullmatch(t.content) for t in self.library.get_added_tokens_decoder().values()):
            return False
        letters = [c for c in map(chr, range(0x100)) if _PLAIN.fullmatch(c)]
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {ord(c): level.pre_tokenize_str(c)[0][0] for c in [" ", *letters]}
        lead = "" if self.split is bare_pieces else " "
        tried = [x for c in letters for x in (c, f"{lead}{c}", f"a{c}", f"{lead}B{c}e")]
        tried += [lead + "".join(letters), "".join(letters[::-1])]
        want = [e.ids for e in self.library.encode_batch_fast(tried, add_special_tokens=False)]
        for self.lower in (False, True):
            if [self._ids(t) for t in tried] == want:
                return True
        return False

    def _ids(self, word: str) -> list[int]:
        """Ids of a plain word, by the model alone."""
        if self.lower:
            word = word.lower()
        if not word.isascii():
            word = word.translate(self.bytes)
        elif word[0] == " ":
            word = self.bytes[32] + word[1:]
        return [token.id for token in self.model.tokenize(word)]

    def _at_once(self, piece: str) -> object:
        """The value of a plain word and of the marks behind it; None if the library must encode the whole piece."""
        plain = _PLAIN.fullmatch(piece) if len(piece) <= MEMO_CHARS else None
        if plain is None:
            return None
        head, tail = plain.groups()
        if not tail:
            return self.value(self._ids(head))
        memo = self.memo
        if memo.get(tail) is None:
            memo[tail] = self._single([tail])[0]
        return memo[head] + memo[tail]

    def _single(self, pieces: list[str]) -> list:
        return list(map(self.value, map(attrgetter("ids"), self.library.encode_batch_fast(pieces, add_special_tokens=False))))

    def _values(self, pieces: list[str]) -> list:
        """The value of each piece. A piece between others has the ids that it has alone, and a text costs less than many
        do; a run in which the id between pieces is met inside a piece as well is encoded piece by piece."""
        if self.between is None:
            return self._single(pieces)
        if self.joined == _BETWEEN_SPACED:
            odd = [p for p in pieces if not _ONE_WORD.fullmatch(p)]
            if odd:
                alone = dict(zip(odd, self._single(odd)))
                rest = iter(self._values([p for p in pieces if p not in alone]))
                return [alone[p] if p in alone else next(rest) for p in pieces]
        runs = [pieces[i : i + JOINED_PIECES] for i in range(0, len(pieces), JOINED_PIECES)]
        texts = [self.joined.join(run) for run in runs]
        out = []
        for run, encoded in zip(runs, self.library.encode_batch_fast(texts, add_special_tokens=False)):
            ids = encoded.ids
            if ids.count(self.between) != len(run) - 1:
                out += self._single(run)
                continue
            ids.append(self.between)
            at = 0
            for _ in run:
                end = ids.index(self.between, at)
                out.append(self.value(ids[at:end]))
                at = end + 1
        return out

    def _learn(self, pieces: list[str]) -> None:
        """Encode the pieces; closing punctuation behind a letter that normalizers keep is a token run of its own."""
        cores = [p.rstrip(_CLOSING) for p in pieces]
        heads = [c if len(c) < len(p) and c and _stays_letter(c[-1]) else p for p, c in zip(pieces, cores)]
        memo = self.memo
        tails = {p[len(h) :] for p, h in zip(pieces, heads) if h is not p}
        fresh = [x for x in {*heads, *tails} if memo.get(x) is None]
        memo.update(zip(fresh, self._values(fresh)))
        for piece, head in zip(pieces, heads):
            if head is not piece:
                memo[piece] = memo[head] + memo[piece[len(head) :]]

    def encode(self, texts: Sequence[str | None]) -> Iterator[list]:
        """For each text the values of its pieces, in order; values of parts must add up."""
        if len(self.memo) > MEMO_PIECES:
            self.memo = _Memo()
        memo = self.memo
        if self.direct:
            memo.at_once = self._at_once
        lookup = memo.__getitem__
        found: list[list] = []
        waiting: dict[int, list[str]] = {}  # the pieces of texts whose values are not all known yet
        for text in texts:
            one = self.split(text) if text else []
            values = list(map(lookup, one))
            if memo.unknown and None in values:
                waiting[len(found)] = one
            found.append(values)
        new, memo.unknown = memo.unknown, []
        if new:
            self._learn(new)
        for i, values in enumerate(found):
            if i in waiting:
                values = [memo[p] if v is None else v for p, v in zip(waiting[i], values)]
            yield values
        for piece in new:
            if len(piece) > MEMO_CHARS:
                memo.pop(piece, None)
                memo.pop(piece.rstrip(_CLOSING), None)


def batches_by_bytes(texts: Iterable[str | None], most: int) -> Iterator[list[str | None]]:
    """Consecutive runs of texts with about ``most`` characters each; a longer text stands alone."""
    run: list[str | None] = []
    size = 0
    for text in texts:
        n = len(text) if text else 0
        if run and size + n > most:
            yield run
            run, size = [], 0
        run.append(text)
        size += n
    if run:
        yield run


@lru_cache(maxsize=1)
def encoder(path: str, kind: str) -> PieceEncoder:
    """The worker's encoder: ``count`` keeps numbers of ids, ``words`` and ``spaced`` 32-bit ids, ``short`` 16-bit ids."""
    import os
    from array import array

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core

    def packed(ids: list[int]) -> bytes:
        return array("I", ids).tobytes()  # little-endian where Spark runs

    if kind == "count":
        return PieceEncoder(path, spaced_pieces, len)
    if kind == "short":
        return PieceEncoder(path, spaced_pieces, lambda ids: array("H", ids).tobytes(), joined=_BETWEEN_SPACED)
    return PieceEncoder(path, bare_pieces, packed, joined=_BETWEEN_BARE) if kind == "words" else PieceEncoder(path, spaced_pieces, packed)
