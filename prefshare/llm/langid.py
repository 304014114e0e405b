"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A
word's likelihood is the sum, over all its segmentations into pieces, of the
product of their probabilities; a forward pass over its characters computes it,
for many words and all languages at once. The probabilities come from expected
counts (forward and backward passes) on a bounded sample of labelled documents. All
letters and pieces of the vocabulary that the sample holds are learned, and runs of
any length count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefshare.functions.flags import quoted
from prefshare.llm.common import rechunked, text_column
from prefshare.llm.words import words_of

UNDETERMINED = "und"
# Documents of the fit for each language, about.
FIT_DOCUMENTS = 400
EM_ROUNDS = 4
# Characters of the words whose segmentations are held at once.
FIT_LETTERS = 1 << 16
# Characters after which sums are rescaled; so many unknown ones do not underflow.
RESCALE = 8
# Weight added to every piece's expected count; probability of any other character.
SMOOTHING = 0.1
UNKNOWN = 1e-7
KEPT_WORDS = 500_000
CHUNK_BYTES = 4 << 20
START = "▁"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary_pieces(path: str) -> list[str]:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())]


def letter_runs(word: str) -> list[str]:
    """The word's runs of letters, in lower case."""
    if not word.isalpha():
        word = "".join(c if c.isalpha() else " " for c in word)
    return word.lower().split()


class Trie:
    """Pieces as states; state 0 is dead, 1 the root. Steps are sorted by state and
    character, so that their number is that of the pieces' characters, whatever the
    size of the alphabet."""

    def __init__(self, pieces: list[str], alphabet: str):
        self.code = {c: i + 1 for i, c in enumerate(alphabet)}
        self.longest = max(map(len, pieces), default=1)
        rows: list[dict[int, int]] = [{}, {}]
        piece = [-1, -1]
        for number, text in enumerate(pieces):
            state = 1
            for c in text:
                following = rows[state].get(self.code[c])
                if following is None:
                    following = len(rows)
                    rows[state][self.code[c]] = following
                    rows.append({})
                    piece.append(-1)
                state = following
            piece[state] = number
        self.width = len(alphabet) + 1
        steps = sorted(
            (state * self.width + c, following)
            for state, row in enumerate(rows)
            for c, following in row.items()
        )
        # The last one is met by no state.
        self.keys = np.array([k for k, _ in steps] + [len(rows) * self.width], np.int64)
        self.following = np.array([f for _, f in steps] + [0], np.int32)
        self.piece = np.array(piece)
        # Characters that are no piece themselves pass with the unknown probability.
        first = self.step(np.ones(self.width, np.int64), np.arange(self.width))
        self.alone = self.piece[first] < 0

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        key = state * np.int64(self.width) + code
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.following[at], 0)

    def codes(self, runs: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Runs of equal length together: (their numbers, characters as codes)."""
        flat = np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32)
        table = np.zeros(max(max(map(ord, self.code)), int(flat.max(initial=0))) + 1, np.int32)
        for c, i in self.code.items():
            table[ord(c)] = i
        coded = table[flat]
        lengths = np.array([len(r) for r in runs], np.int64)
        starts = np.cumsum(lengths) - lengths
        out = []
        for n in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == n)
            out.append((rows, coded[starts[rows][:, None] + np.arange(n)]))
        return out


def _edges(trie: Trie, codes: np.ndarray, at: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces that start at a character: (length, rows, piece numbers or -1 for an
    unknown character)."""
    rows = np.arange(len(codes))
    state = np.ones(len(codes), np.int64)
    for length in range(1, codes.shape[1] - at + 1):
        state = trie.step(state, codes[rows, at + length - 1])
        if length == 1:
            lone = trie.alone[codes[:, at]]
            if lone.any():
                where = np.flatnonzero(lone)
                yield 1, where, np.full(len(where), -1)
        alive = np.flatnonzero(state)
        if not len(alive):
            return
        rows, state = rows[alive], state[alive]
        piece = trie.piece[state]
        ends = np.flatnonzero(piece >= 0)
        if len(ends):
            yield length, rows[ends], piece[ends]


def forward(trie: Trie, chances: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Log likelihoods (runs x languages) of runs of one length.

    ``chances`` (pieces and, last, an unknown character; x languages). Sums at
    the last few characters are kept and rescaled together, so that memory does
    not grow with the length and long runs do not underflow.
    """
    count, n = codes.shape
    ring = np.zeros((trie.longest + 1, count, chances.shape[1]))
    ring[0] = 1
    scale = np.zeros((count, chances.shape[1]))
    for at in range(n):
        here = ring[at % len(ring)]
        for length, rows, piece in _edges(trie, codes, at):
            ring[(at + length) % len(ring)][rows] += here[rows] * chances[piece]
        here[:] = 0
        if at % RESCALE == RESCALE - 1:
            top = ring.max(axis=0)
            ring /= top
            scale += np.log(top)
    return np.log(ring[n % len(ring)]) + scale


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    alphabet: str
    pieces: tuple[str, ...]
    chances: np.ndarray

    def digest(self) -> str:
        text = "\n".join([*self.languages, self.alphabet, *self.pieces])
        return hashlib.sha256(text.encode() + self.chances.tobytes()).hexdigest()

    @staticmethod
    def fit(
        counts: list[tuple[str, str, int]], vocabulary: list[str], rounds: int = EM_ROUNDS
    ) -> Model:
        """Fit to (language, run of letters, count). Pieces that no run contains
        are left out; without any row the model knows no language."""
        languages = sorted({lang for lang, _, _ in counts})
        if not languages:
            return Model((), "", (), np.zeros((1, 0)))
        runs = sorted({START + run for _, run, _ in counts})
        number = {run: i for i, run in enumerate(runs)}
        amount = np.zeros((len(runs), len(languages)))
        for lang, run, n in counts:
            amount[number[START + run], languages.index(lang)] += n
        letters = set().union(*runs)
        pieces = sorted({p for p in vocabulary if p and letters.issuperset(p)} | {START})
        alphabet = "".join(sorted(set().union(*pieces)))
        trie = Trie(pieces, alphabet)
        groups = trie.codes(runs)
        chances = np.full((len(pieces) + 1, len(languages)), 1 / len(pieces))
        chances[-1] = UNKNOWN
        for _ in range(rounds):
            expected = np.zeros_like(chances)
            for rows, codes in groups:
                step = max(1, FIT_LETTERS // codes.shape[1])
                for at in range(0, len(rows), step):
                    some = slice(at, at + step)
                    _expect(trie, chances, codes[some], amount[rows[some]], expected)
            expected = expected[:-1] + SMOOTHING
            chances[:-1] = (1 - UNKNOWN) * expected / expected.sum(axis=0)
        return Model(tuple(languages), alphabet, tuple(pieces), chances)


def _expect(
    trie: Trie, chances: np.ndarray, codes: np.ndarray, amount: np.ndarray, out: np.ndarray
) -> None:
    """Add the expected piece counts of runs of one length to ``out``.

    Sums that are still open are rescaled together every few characters; the logarithms
    of the scales up to each character are kept beside them.
    """
    count, n = codes.shape
    shape = (n + 1, count, chances.shape[1])
    edges = [list(_edges(trie, codes, at)) for at in range(n)]
    ahead, ahead_log = np.zeros(shape), np.zeros(shape)
    ahead[0] = 1
    log = np.zeros(shape[1:])
    for at in range(n):
        for length, rows, piece in edges[at]:
            ahead[at + length][rows] += ahead[at][rows] * chances[piece]
        if at % RESCALE == RESCALE - 1:
            reached = ahead[at + 1 : at + 1 + trie.longest]
            top = reached.max(axis=0)
            reached /= top
            log = log + np.log(top)
        ahead_log[at + 1] = log
    back, back_log = np.zeros(shape), np.zeros(shape)
    back[n] = 1
    log = np.zeros(shape[1:])
    for at in range(n - 1, -1, -1):
        for length, rows, piece in edges[at]:
            # What lies ahead has been scaled up to the last rescaling.
            back[at][rows] += chances[piece] * back[at + length][rows]
        if (n - 1 - at) % RESCALE == RESCALE - 1:
            reached = back[at : at + trie.longest]
            top = reached.max(axis=0)
            reached /= top
            log = log + np.log(top)
            back_log[at : at + trie.longest] = log
        else:
            back_log[at] = log
    whole = np.log(ahead[n]) + ahead_log[n]
    for at in range(n):
        for length, rows, piece in edges[at]:
            scale = ahead_log[at][rows] + back_log[at + length][rows] - whole[rows]
            value = ahead[at][rows] * chances[piece] * back[at + length][rows]
            value *= np.exp(scale) * amount[rows]
            for k in range(out.shape[1]):
                out[:, k] += np.bincount(
                    np.where(piece < 0, len(out) - 1, piece), value[:, k], len(out)
                )


class Scorer:
    """A worker's scores of the words it has met, by the words' hash."""

    def __init__(self, model: Model):
        self.model = model
        self.trie = Trie(list(model.pieces), model.alphabet)
        self.known = np.zeros(0, np.uint64)
        # Log likelihoods, letters, and letters that some learned piece has.
        self.values = np.zeros((0, len(model.languages) + 2), np.float32)

    def _new(self, words: list[str]) -> np.ndarray:
        runs, owner = [], []
        for i, word in enumerate(words):
            for run in letter_runs(word):
                runs.append(START + run)
                owner.append(i)
        out = np.zeros((len(words), len(self.model.languages) + 2))
        if runs and self.model.languages:
            scores = np.zeros((len(runs), len(self.model.languages)))
            known = np.zeros(len(runs))
            for rows, codes in self.trie.codes(runs):
                scores[rows] = forward(self.trie, self.model.chances, codes)
                known[rows] = (codes[:, 1:] > 0).sum(axis=1)
            np.add.at(out[:, :-2], owner, scores)
            np.add.at(out[:, -1], owner, known)
        np.add.at(out[:, -2], owner, [len(run) - 1 for run in runs])
        # As they are kept, so that a score does not depend on what was met before.
        return out.astype(np.float32)

    def score(self, texts: pa.Array) -> np.ndarray:
        """Sums of the words' values for each text."""
        words = words_of(texts)
        width = len(self.model.languages) + 2
        if not len(words.starts):
            return np.zeros((len(texts), width))
        found, first, where = np.unique(
            words.hashes(), return_index=True, return_inverse=True
        )
        at = np.minimum(np.searchsorted(self.known, found), max(len(self.known) - 1, 0))
        hit = self.known[at] == found if len(self.known) else np.zeros(len(found), bool)
        values = np.zeros((len(found), width), np.float32)
        values[hit] = self.values[at[hit]]
        if not hit.all():
            new = np.flatnonzero(~hit)
            values[new] = self._new([words.text(i) for i in first[new].tolist()])
            if len(self.known) + len(new) <= KEPT_WORDS:
                known = np.concatenate([self.known, found[new]])
                order = np.argsort(known, kind="stable")
                self.known = known[order]
                self.values = np.concatenate([self.values, values[new]])[order]
        sums = np.zeros((len(where) + 1, width))
        np.cumsum(values[where], axis=0, dtype=np.float64, out=sums[1:])
        return sums[words.bounds[1:]] - sums[words.bounds[:-1]]


_SCORERS: dict[str, Scorer] = {}


def _scorer(model: Model, digest: str) -> Scorer:
    if digest not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[digest] = Scorer(model)
    return _SCORERS[digest]


def decide(model: Model, values: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and posterior probability (equal priors) from sums of values."""
    if not model.languages:
        return [UNDETERMINED] * len(values), np.zeros(len(values))
    logs, letters = values[:, :-2], values[:, -2] > 0
    best = logs.argmax(axis=1)
    chance = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
    names = [
        model.languages[i] if has else UNDETERMINED
        for i, has in zip(best.tolist(), letters.tolist(), strict=True)
    ]
    return names, np.where(letters, chance, 0.0)


def held_out(doc: str = "doc_id") -> Column:
    """Rows the fit never sees; a null doc_id counts as the empty text."""
    key = F.coalesce(quoted(doc).cast("string"), F.lit(""))
    return F.crc32(key) % 4 == 2


def fit_model(
    docs: DataFrame,
    vocabulary: str,
    documents: int = FIT_DOCUMENTS,
    doc: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> Model:
    """A model from about ``documents`` documents for each language that are not
    held out and have a text and a language, chosen by a hash of doc_id. Their
    counted words, not their texts, go to the driver."""
    rows = docs.filter(~held_out(doc) & quoted(text).isNotNull() & quoted(lang).isNotNull())
    rows = rows.select(
        quoted(lang).alias("lang"),
        quoted(text).alias("text"),
        F.pmod(F.xxhash64(quoted(doc), quoted(text)), F.lit(1_000_003)).alias("h"),
    )
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Model.fit([], [])
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, F.lit(documents / n)).otherwise(share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[str, str], int] = {}
            for name, t in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                for run in letter_runs(t):
                    counts[name, run] = counts.get((name, run), 0) + 1
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([k[0] for k in counts], pa.string()),
                    "run": pa.array([k[1] for k in counts], pa.string()),
                    "n": pa.array(list(counts.values()), pa.int64()),
                }
            )

    some = rows.filter(F.col("h") < share * 1_000_003).select("lang", "text")
    counted = some.mapInArrow(count, "lang string, run string, n bigint")
    totals = counted.groupBy("lang", "run").agg(F.sum("n").alias("n")).toArrow()
    counts = zip(*(totals[c].to_pylist() for c in ("lang", "run", "n")), strict=True)
    return Model.fit(list(counts), vocabulary_pieces(vocabulary))


def identify(
    docs: DataFrame, model: Model, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score.

    A text that is null, empty or has no letter is undetermined with score 0, as
    is every text if nothing could be learned. Of languages that fit equally the
    first by name is taken. Other columns are not read.
    """
    digest = model.digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model, digest)
        for batch in rechunked(batches, "_text", CHUNK_BYTES):
            names, chance = decide(model, scorer.score(text_column(batch, "_text")))
            keep = [
                batch.column(batch.schema.get_field_index(c)) for c in ("_doc", "_held")
            ]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(names, pa.string()), pa.array(chance)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        quoted(doc).cast("bigint").alias("_doc"),
        held_out(doc).alias("_held"),
        quoted(text).alias("_text"),
    )
    return rows.mapInArrow(
        run, "doc_id bigint, held_out boolean, lang_pred string, score double"
    )


def identified(model: Model, values: np.ndarray) -> np.ndarray:
    """Which texts have a language: ``decide`` names one, and learned pieces hold half of
    the letters at least. Where nothing could be learned any letter will do."""
    letters, known = values[:, -2], values[:, -1]
    if not model.languages:
        return letters > 0
    named = np.array([name != UNDETERMINED for name in decide(model, values)[0]], bool)
    return named & (2 * known >= letters)


def keep_identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose text has a language of the model, see ``identified``, unchanged.
    Null and empty texts and those without a letter go, as do those in letters that no
    learned piece has. A table from which nothing could be learned keeps every text with
    a letter."""
    digest = model.digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model, digest)
        for batch in rechunked(batches, text, CHUNK_BYTES):
            keep = identified(model, scorer.score(text_column(batch, text)))
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
