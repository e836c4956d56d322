"""Language identification with a linear-chain conditional random field over words."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain as chained
from operator import add
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wicketworks.llm.common import release_memory, releasing, whole_row

UNKNOWN = "und"
# The training sample: documents per language, stretches of a document and words of a stretch.
SAMPLE_DOCS = 500
STRETCHES = 4
STRETCH_WORDS = 32
SEQUENCES = 3000
SEQUENCE_WORDS = 48
SWITCH_AFTER = 12  # mean length of one language within a training sequence
EPOCHS = 4
BUCKETS = 1 << 15
LEXICON_WORDS = 20_000
LEXICON_COUNT = 4
MOST_LANGUAGES = 512
# A document whose best language has less than this share of its words has no main language.
LEAST_SCORE = 0.34
MEMO_WORDS = 300_000
MEMO_CHARS = 64
MEMO_PARTS = 60_000
WORDS_AT_ONCE = 4096
CHAIN = 64  # words per block of the forward-backward scan
BATCH_CHARS = 512 << 10


def letters_of(token: str) -> str:
    """The token's letters, lower-cased; empty for numbers and punctuation."""
    if not token.isalpha():
        token = token.rstrip(".,;:!?")
        if not token.isalpha():
            token = "".join(filter(str.isalpha, token))
    return token.lower()


class _Buckets(dict):
    """Buckets of the features that come from a part of a word, kept for the parts met first."""

    def __init__(self, names: Callable[[str], list[str]]) -> None:
        super().__init__()
        self.names = names

    def __missing__(self, part: str) -> tuple[int, ...]:
        found = tuple(crc32(x.encode()) % BUCKETS for x in self.names(part))
        if len(self) < MEMO_PARTS:
            self[part] = found
        return found


_HEADS = _Buckets(lambda head: [f"p{head[:n]}" for n in range(1, len(head) + 1)])
_TAILS = _Buckets(lambda tail: [f"s{tail[-n:]}" for n in range(1, len(tail) + 1)])
_GRAMS = _Buckets(lambda gram: [gram])


def word_features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Affixes of up to four letters, letter n-grams of two and three, and the word itself if the lexicon has it."""
    marked = f"<{word}>"
    two = list(map(add, marked, marked[1:]))
    three = map(add, two, marked[2:])
    found = [*_HEADS[word[:4]], *_TAILS[word[-4:]], *chained.from_iterable(map(_GRAMS.__getitem__, two)), *chained.from_iterable(map(_GRAMS.__getitem__, three))]
    if word in lexicon:
        found.append(BUCKETS + lexicon[word])
    return found


class _Characters:
    """Hashes of the features of many words at once: the buckets that ``word_features`` names.

    A CRC32 is the exclusive or of what each character adds, given the bytes behind it, and of a part that the length alone decides.
    """

    def __init__(self) -> None:
        self.place = np.zeros(0x110000, np.int32)  # by code point; 0: not met yet
        self.bytes = np.zeros(1, np.int64)
        self.adds = np.zeros((1, 4 * 3 + 1), np.uint32)
        self.plain = np.array([crc32(bytes(n)) for n in range(4 * 4 + 2)], np.uint32)
        self.marks = {m: np.array([crc32(m + bytes(n)) for n in range(4 * 4 + 1)], np.uint32) ^ self.plain[1:] for m in (b"p", b"s")}

    def numbers(self, text: str) -> np.ndarray:
        """The text's characters as rows of the tables, which grow by those not met before."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        found = self.place[codes]
        if not found.all():
            new = np.unique(codes[found == 0])
            coded = [chr(c).encode() for c in new.tolist()]
            self.place[new] = np.arange(len(new)) + len(self.bytes)
            adds = [[crc32(c + bytes(n)) for n in range(self.adds.shape[1])] for c in coded]
            many = np.fromiter(map(len, coded), np.int64, len(coded))
            self.adds = np.vstack([self.adds, np.array(adds, np.uint32) ^ self.plain[many[:, None] + np.arange(self.adds.shape[1])]])
            self.bytes = np.concatenate([self.bytes, many])
            found = self.place[codes]
        return found

    def buckets(self, numbers: np.ndarray, at: np.ndarray, length: int, mark: bytes = b"") -> np.ndarray:
        """Buckets of the parts of ``length`` characters from each place ``at`` on, behind a mark."""
        behind, value = np.zeros(len(at), np.int64), np.zeros(len(at), np.uint32)
        for i in range(length - 1, -1, -1):
            own = numbers[at + i]
            value ^= self.adds[own, behind]
            behind += self.bytes[own]
        if mark:
            value ^= self.marks[mark][behind]
            behind += 1
        return (value ^ self.plain[behind]) % np.uint32(BUCKETS)


def _entering(steps: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The message before each of many transfer matrices, as ``start`` is carried over them one by one.

    The matrices are cut into about as many groups as a group has; the groups advance side by side.
    """
    n, k = steps.shape[:2]
    size = int(np.sqrt(n)) + 1
    groups = -(-n // size)
    padded = np.broadcast_to(np.eye(k), (groups * size, k, k)).copy()
    padded[:n] = steps
    padded = padded.reshape(groups, size, k, k)
    whole = padded[:, 0]
    for t in range(1, size):
        whole = whole @ padded[:, t]
        whole = whole / whole.max((1, 2), keepdims=True)
    state = np.empty((groups, 1, k))
    message = start / start.sum()
    for g in range(groups):
        state[g, 0] = message
        message = message @ whole[g]
        message = message / message.sum()
    out = np.empty((groups, size, k))
    for t in range(size):
        out[:, t] = state[:, 0]
        state = state @ padded[:, t]
        state = state / state.sum(2, keepdims=True)
    return out.reshape(-1, k)[:n]


def forward_backward(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Posterior probability of every label at every word, for chains one behind the other.

    ``first`` marks each chain's first word, where the start weights stand for the transition. The
    words are cut into blocks of 64; the product of each block's transfer matrices carries the messages
    over it, so all blocks advance side by side and the result is that of one pass from end to end.
    """
    n, k = scores.shape
    if not n:
        return scores
    blocks = -(-n // CHAIN)
    emission = np.ones((blocks * CHAIN, k))
    emission[:n] = np.exp(scores - scores.max(1, keepdims=True))
    emission = emission.reshape(blocks, CHAIN, k)
    begins = np.zeros(blocks * CHAIN, bool)
    begins[:n], begins[n:] = first, True
    begins = begins.reshape(blocks, CHAIN)
    step, initial = np.exp(transitions - transitions.max()), np.exp(start - start.max())

    starting = [np.flatnonzero(begins[:, t]) for t in range(CHAIN)]

    def ahead(state: np.ndarray, t: int) -> np.ndarray:
        """Messages (rows of the last axis) moved over word t of every block."""
        moved = (state.reshape(-1, k) @ step).reshape(state.shape)
        if len(starting[t]):
            moved[starting[t]] = state[starting[t]].sum(-1, keepdims=True) * initial
        moved *= emission[:, t] if state.ndim == 2 else emission[:, t, None, :]
        return moved

    product = np.broadcast_to(np.eye(k), (blocks, k, k))
    for t in range(CHAIN):
        product = ahead(product, t)
        product /= product.max((1, 2), keepdims=True)
    entering = _entering(product, initial)
    leaving = _entering(product[::-1].transpose(0, 2, 1), np.ones(k))[::-1]
    alpha = np.empty((CHAIN, blocks, k))
    state = entering
    for t in range(CHAIN):
        state = ahead(state, t)
        state = state / state.sum(1, keepdims=True)
        alpha[t] = state
    out = np.empty((blocks, CHAIN, k))
    state = leaving
    for t in range(CHAIN - 1, -1, -1):
        both = alpha[t] * state
        out[:, t] = both / both.sum(1, keepdims=True)
        weighted = emission[:, t] * state
        state = weighted @ step.T
        if len(starting[t]):
            state[starting[t]] = (weighted[starting[t]] @ initial)[:, None]
        state /= state.sum(1, keepdims=True)
    return out.reshape(-1, k)[:n]


@dataclass
class CrfModel:
    """Weights: ``emission`` (feature x label), ``transitions`` (label x label), ``start``; and the lexicon."""

    labels: list[str]
    lexicon: dict[str, int]
    emission: np.ndarray
    transitions: np.ndarray
    start: np.ndarray

    def word_scores(self, words: Sequence[str], characters: _Characters | None = None) -> np.ndarray:
        """Summed weights of each word's ``word_features``; features of few words at a time, as they take much memory."""
        characters = characters or _Characters()
        parts = [np.zeros((0, len(self.labels)))]
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at : at + WORDS_AT_ONCE]
            many = np.fromiter(map(len, some), np.int64, len(some))
            ends = np.cumsum(many + 2)
            first = ends - many - 1  # each word's first letter in "<word><word>"
            numbers = characters.numbers("<" + "><".join(some) + ">")
            inside = np.ones(len(numbers), bool)
            inside[ends - 1] = False
            two = np.flatnonzero(inside)
            summed = self.emission[characters.buckets(numbers, two, 2)]
            inside[ends - 2] = False
            three = np.flatnonzero(inside)
            summed[inside[two]] += self.emission[characters.buckets(numbers, three, 3)]
            total = np.add.reduceat(summed, np.cumsum(many + 1) - many - 1, axis=0)
            for n in range(1, 5):
                long = np.flatnonzero(many >= n)
                total[long] += self.emission[characters.buckets(numbers, first[long], n, b"p")]
                total[long] += self.emission[characters.buckets(numbers, first[long] + many[long] - n, n, b"s")]
            known = [(i, BUCKETS + self.lexicon[w]) for i, w in enumerate(some) if w in self.lexicon]
            if known:
                row, index = np.array(known).T
                total[row] += self.emission[index]
            parts.append(total)
        return np.vstack(parts)


def _sequences(stretches: list[tuple[int, list[str]]], labels: int, rng) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Training text that switches languages: parts of stretches, each labelled by its document's language."""
    by_label = [[w for i, w in stretches if i == k] for k in range(labels)]
    words: list[str] = []
    gold: list[int] = []
    for _ in range(SEQUENCES):
        left = SEQUENCE_WORDS
        while left:
            k = int(rng.integers(labels))
            words_of = by_label[k][int(rng.integers(len(by_label[k])))]
            at = int(rng.integers(len(words_of)))
            part = words_of[at : at + min(left, int(rng.geometric(1 / SWITCH_AFTER)))]
            words += part
            gold += [k] * len(part)
            left -= len(part)
    return words, np.array(gold).reshape(SEQUENCES, SEQUENCE_WORDS), np.arange(SEQUENCES)


def fit(stretches: list[tuple[str, list[str]]], seed: int = 0) -> CrfModel:
    """Conditional likelihood by AdaGrad on switching sequences made of the labelled stretches."""
    labels = sorted({lang for lang, _ in stretches})
    if len(labels) > MOST_LANGUAGES:
        raise ValueError(f"{len(labels)} languages are more than {MOST_LANGUAGES}")
    number = {lang: i for i, lang in enumerate(labels)}
    counts = Counter(w for _, words in stretches for w in words)
    frequent = sorted((w for w, n in counts.items() if n >= LEXICON_COUNT), key=lambda w: (-counts[w], w))[:LEXICON_WORDS]
    lexicon = {w: i for i, w in enumerate(frequent)}
    k = len(labels)
    model = CrfModel(labels, lexicon, np.zeros((BUCKETS + len(lexicon), k)), np.zeros((k, k)), np.zeros(k))
    if k < 2:
        return model
    rng = np.random.default_rng(seed)
    words, gold, order = _sequences([(number[lang], w) for lang, w in stretches], k, rng)
    distinct = sorted(set(words))
    row = {w: i for i, w in enumerate(distinct)}
    features = [np.array(word_features(w, lexicon)) for w in distinct]
    ids = np.array([row[w] for w in words]).reshape(gold.shape)
    grads = [np.full(x.shape, 1e-3) for x in (model.emission, model.transitions, model.start)]
    first = np.zeros((64, SEQUENCE_WORDS), bool)
    first[:, 0] = True
    for epoch in range(EPOCHS):
        rng.shuffle(order)
        for at in range(0, len(order), 64):
            chosen = order[at : at + 64]
            flat = [features[i] for i in ids[chosen].ravel()]
            lengths = np.array([len(f) for f in flat])
            index = np.concatenate(flat)
            scores = np.add.reduceat(model.emission[index], np.cumsum(lengths) - lengths, axis=0)
            truth = np.eye(k)[gold[chosen]]
            post, pairs = _pair_posteriors(scores.reshape(*truth.shape), model.transitions, model.start)
            off = (post - truth).reshape(-1, k)
            emission = np.zeros_like(model.emission)
            np.add.at(emission, index, np.repeat(off, lengths, axis=0))
            seen = np.einsum("bti,btj->ij", truth[:, :-1], truth[:, 1:])
            steps = (emission, pairs - seen, (post - truth)[:, 0].sum(0))
            for weight, total, g in zip((model.emission, model.transitions, model.start), grads, steps):
                g = g / len(chosen) + 1e-6 * weight
                total += g * g
                weight -= 0.2 / np.sqrt(total) * g
    model.emission = model.emission.astype(np.float32)
    return model


def _pair_posteriors(scores: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of labels (batch x words x labels) and summed posteriors of neighbouring pairs."""
    emission = np.exp(scores - scores.max(-1, keepdims=True))
    step = np.exp(transitions)
    batch, words, k = scores.shape
    alpha, beta = np.empty_like(scores), np.ones_like(scores)
    state = np.exp(start) * emission[:, 0]
    alpha[:, 0] = state / state.sum(1, keepdims=True)
    for t in range(1, words):
        state = (alpha[:, t - 1] @ step) * emission[:, t]
        alpha[:, t] = state / state.sum(1, keepdims=True)
    for t in range(words - 2, -1, -1):
        state = (emission[:, t + 1] * beta[:, t + 1]) @ step.T
        beta[:, t] = state / state.sum(1, keepdims=True)
    post = alpha * beta
    post /= post.sum(-1, keepdims=True)
    pairs = alpha[:, :-1, :, None] * step * (emission * beta)[:, 1:, None, :]
    pairs /= pairs.sum((2, 3), keepdims=True)
    return post, pairs.sum((0, 1))


def training_stretches(docs: DataFrame, label: str, key: Column, text: str = "text") -> list[tuple[str, list[str]]]:
    """At most about SAMPLE_DOCS documents of each label, four stretches of 32 words of each, spread over the text.

    Documents are chosen by the hash of ``key``, so the sample is the same wherever it is drawn.
    """
    clean = docs.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{text}`").isNotNull()).select(
        F.col(f"`{label}`").alias("label"), F.col(f"`{text}`").alias("text"), F.xxhash64(key, F.lit("sample")).alias("h")
    )
    counts = {r["label"]: r["count"] for r in clean.groupBy("label").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"there are more than {MOST_LANGUAGES} languages")
    if not counts:
        return []
    width = {lang: min(1.0, SAMPLE_DOCS / n) for lang, n in counts.items()}
    limits = F.create_map(*[F.lit(x) for lang, w in width.items() for x in (lang, int(w * (2**62)))])
    drawn = clean.where(F.shiftrightunsigned("h", 2) < limits[F.col("label")])

    def stretched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for lang, text_, h in zip(*(batch.column(c).to_pylist() for c in ("label", "text", "h"))):
                words = list(filter(None, map(letters_of, text_.split())))
                room = max(0, len(words) - STRETCH_WORDS)
                for at in sorted({room * i // max(1, STRETCHES - 1) for i in range(STRETCHES)}):
                    out[0].append(lang), out[1].append(h), out[2].append(words[at : at + STRETCH_WORDS])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.string()))], ["label", "h", "words"])

    taken = drawn.mapInArrow(stretched, "label string, h bigint, words array<string>").where("size(words) > 0")
    found = sorted((r["label"], r["h"], r["words"]) for r in taken.collect())
    return [(lang, words) for lang, _, words in found]


class _Rows(dict):
    """Numbers tokens as they are met; those met first since the last look are ``unknown``."""

    def __init__(self) -> None:
        super().__init__()
        self.unknown: list[str] = []
        self.used = 0

    def __missing__(self, token: str) -> int:
        self.unknown.append(token)
        self[token] = row = self.used
        self.used = row + 1
        return row


class _Tagger:
    """Scores of tokens, remembered, and posteriors of batches of texts."""

    def __init__(self, model: CrfModel) -> None:
        self.model = model
        self.characters = _Characters()
        self.clear()

    def clear(self) -> None:
        self.rows = _Rows()
        self.scores = np.zeros((1 << 12, len(self.model.labels)), np.float32)
        self.lettered = np.zeros(1 << 12, bool)

    def learn(self, tokens: list[str]) -> None:
        """Scores of the tokens that were numbered last."""
        words = list(map(letters_of, tokens))
        end = self.rows.used
        if end > len(self.scores):  # doubled, so that tokens are copied no more than once on average
            more = max(end, 2 * len(self.scores)) - len(self.scores)
            self.scores = np.concatenate([self.scores, np.zeros((more, self.scores.shape[1]), np.float32)])
            self.lettered = np.concatenate([self.lettered, np.zeros(more, bool)])
        own = np.arange(end - len(tokens), end)
        self.lettered[own] = has = np.fromiter(map(bool, words), bool, len(words))
        self.scores[own[has]] = self.model.word_scores(list(filter(None, words)), self.characters)

    def posteriors(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Posteriors of all words, the number of words of each text, and which tokens are words."""
        if self.rows.used > MEMO_WORDS:
            self.clear()
        split = [t.split() if t else [] for t in texts]
        lookup = self.rows.__getitem__
        rows = [np.fromiter(map(lookup, tokens), np.int64, len(tokens)) for tokens in split]
        missing, self.rows.unknown = self.rows.unknown, []
        if missing:
            self.learn(missing)
        lettered = [np.flatnonzero(self.lettered[r]) for r in rows]
        counts = np.array([len(x) for x in lettered])
        chain = np.concatenate([r[x] for r, x in zip(rows, lettered)])
        first = np.zeros(len(chain), bool)
        first[(np.cumsum(counts) - counts)[counts > 0]] = True
        post = forward_backward(self.scores[chain].astype(np.float64), first, self.model.transitions, self.model.start)
        for t in missing:
            if len(t) > MEMO_CHARS:
                self.rows.pop(t)
        return post, counts, lettered


def label_documents(text: Column, model: CrfModel) -> Column:
    """Struct of ``lang_pred``, ``score``, ``n_words`` and ``n_switches`` for whole texts.

    The words' posteriors are added up; the language with the largest sum wins and its share is the score.
    A text that is null or has no letter is ``und`` with score 0.
    """
    from wicketworks.llm.pieces import batches_by_bytes, encoder

    @F.arrow_udf("struct<lang_pred:string,score:double,n_words:bigint,n_switches:bigint>")
    @releasing
    def labelled(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder.cache_clear()  # what another operator remembered in this worker would stay beside this one's memo
        release_memory()
        tagger = _Tagger(model)
        for part in parts:
            names: list[str] = []
            shares: list[float] = []
            many: list[int] = []
            switches: list[int] = []
            for batch in batches_by_bytes(part.to_pylist(), BATCH_CHARS):
                if not model.labels:
                    n = len(batch)
                    names += [UNKNOWN] * n
                    shares, many, switches = shares + [0.0] * n, many + [0] * n, switches + [0] * n
                    continue
                post, counts, _ = tagger.posteriors(batch)
                ends = np.cumsum(counts)
                best = post.argmax(1)
                for n, end in zip(counts.tolist(), ends.tolist()):
                    own = post[end - n : end]
                    total = own.sum(0)
                    top = int(total.argmax()) if n else 0
                    names.append(model.labels[top] if n else UNKNOWN)
                    shares.append(float(min(1.0, total[top] / n)) if n else 0.0)
                    many.append(n)
                    switches.append(int((np.diff(best[end - n : end]) != 0).sum()))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(shares, pa.float64()), pa.array(many, pa.int64()), pa.array(switches, pa.int64())], ["lang_pred", "score", "n_words", "n_switches"])

    return labelled(text)


def word_confidence(text: Column, model: CrfModel) -> Column:
    """Mean over a text's words of the posterior of each word's best language, in whichever languages; null without a letter.

    With no language to tell, every text with a letter has 1.
    """
    from wicketworks.llm.pieces import batches_by_bytes, encoder

    @F.arrow_udf("double")
    @releasing
    def judged(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder.cache_clear()  # what another operator remembered in this worker would stay beside this one's memo
        release_memory()
        tagger = _Tagger(model)
        for part in parts:
            sure: list[float | None] = []
            for batch in batches_by_bytes(part.to_pylist(), BATCH_CHARS):
                if not model.labels:
                    sure += [1.0 if any(map(str.isalpha, t or "")) else None for t in batch]
                    continue
                post, counts, _ = tagger.posteriors(batch)
                best = post.max(1)
                sure += [float(best[end - n : end].mean()) if n else None for n, end in zip(counts.tolist(), np.cumsum(counts).tolist())]
            yield pa.array(sure, pa.float64())

    return judged(text)


def language_spans(text: Column, model: CrfModel) -> Column:
    """Runs of words of one language: array of (first token, last token, lang, mean posterior); tokens are split at white space."""
    from wicketworks.llm.pieces import batches_by_bytes

    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("lang", pa.string()), ("score", pa.float64())]))

    @F.arrow_udf("array<struct<first:bigint,last:bigint,lang:string,score:double>>")
    def spanned(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = _Tagger(model)
        for part in parts:
            out = []
            for batch in batches_by_bytes(part.to_pylist(), BATCH_CHARS):
                if not model.labels:
                    out += [[] for _ in batch]
                    continue
                post, counts, tokens = tagger.posteriors(batch)
                best = post.argmax(1)
                end = 0
                for at in tokens:
                    own, probabilities = best[end : end + len(at)], post[end : end + len(at)].max(1)
                    end += len(at)
                    cuts = [0, *(np.flatnonzero(np.diff(own)) + 1), len(own)] if len(own) else []
                    out.append([{"first": at[i], "last": at[j - 1], "lang": model.labels[own[i]], "score": probabilities[i:j].mean()} for i, j in zip(cuts, cuts[1:])])
            yield pa.array(out, kind)

    return spanned(text)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def identify_languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", seed: int = 0) -> DataFrame:
    """All documents labelled by a model learned from those that are not held out.

    Columns: id, ``held_out``, ``lang_pred``, ``score``, ``n_words``, ``n_switches``. Training reads text and non-null labels of
    a bounded sample (500 documents of each language, 128 words of each); predictions read the text alone. With no
    label to learn from every document is ``und``; repeated rows are labelled each.
    """
    key = F.col(f"`{doc_id}`")
    model = fit(training_stretches(docs.where(key.isNotNull() & ~held_out(key)), lang, key, text), seed)
    labelled = docs.select(key.alias("_id"), held_out(key).alias("held_out"), label_documents(F.col(f"`{text}`"), model).alias("_l"))
    return labelled.select(F.col("_id").alias(doc_id), "held_out", "_l.*")


def keep_identified(
    docs: DataFrame, least_score: float = LEAST_SCORE, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", seed: int = 0
) -> DataFrame:
    """The documents in a language or several: those without a letter and those whose words are told with low confidence go.

    With no label to learn from every document with a letter stays. A null or empty text has no letter and goes;
    repeated rows are judged each; extra columns may have any name and are kept as they are.
    """
    key = F.col(f"`{doc_id}`")
    model = fit(training_stretches(docs.where(key.isNotNull() & ~held_out(key)), lang, key, text), seed)
    judged = docs.select(whole_row(docs).alias("_doc"), word_confidence(F.col(f"`{text}`"), model).alias("_sure"))
    return judged.where(F.col("_sure") >= least_score).select("_doc.*")
