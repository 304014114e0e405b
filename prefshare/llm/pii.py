"""Personal data: patterns, and a skip-chain conditional random field on top.

Nodes of a document's field are its tokens with a digit or an at sign. Neighbours
in the text share a chain potential, near (parts of one entity) or far; tokens
that repeat, or hold the same digits or the same mailbox name, share a skip
potential with the first and the last occurrence before, wherever in the document
those are. Tokens that a pattern covers are known; loopy belief propagation, until
the messages settle, carries what is known to the tokens like them. The field is
fitted by pseudo-likelihood to the patterns' labels on a bounded sample, where a
token that is like a covered one but not covered itself has no label: whether such
tokens agree is what the field is for. What it finds beyond the patterns is added to
their spans.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefshare.functions.flags import quoted
from prefshare.llm.common import rechunked, text_column

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
# Documents of the fit: at most so many, of at most so many characters each.
FIT_DOCUMENTS = 2_000
FIT_CHARS = 20_000
FIT_STEPS = 300
HASHES = 1 << 40
# Messages have settled when none changes by more than this (in logarithms).
SETTLED = 1e-4
# Rounds after which steps get smaller, so that messages that swing settle as well.
FULL_STEPS = 100
# The weight of knowing a node's label.
KNOWN = 50.0
# Penalties of the weights; skip potentials have few examples and a small one.
PENALTY, SKIP_PENALTY = 1e-4, 1e-7
# A token beyond the patterns needs this marginal probability if skip edges lead to a
# covered one, and this one if only its shape and its neighbours speak for it.
ALIKE, ADDED = 0.5, 0.95
CHUNK_BYTES = 2 << 20

_DIGIT = re.compile("[0-9]")
_MARK = re.compile("[0-9@]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits cannot be entered in its middle, so each run is tried once.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"\S+")

Span = tuple[int, int, int]


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches in linear time: the mailbox name is read back from its @."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, 0, domain.end()
            floor = domain.end()
        at = text.find("@", max(at + 1, floor))


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the patterns' matches, by start and then by kind."""
    found = list(_emails(text))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


@dataclass
class Nodes:
    """Tokens of one document, and edges (i, j, type) between them."""

    spans: list[tuple[int, int]]
    features: list[list[int]]
    edges: list[tuple[int, int, int]]


# Names of the features, in the order of their columns.
FEATURES = (
    "bias at dot1 dot2 dot3 dash open close plus equals quote colon lower upper "
    "digits1 digits2 digits3 digits4 digits5 digits6 digits7 digits8 digits9 digits10 "
    "digits11 digits12 digits13 digits14 digits15 digits16 digits17 digits18 digits19 "
    "longer pure groups near_before near_after plus_before"
).split()
_AT = {name: i for i, name in enumerate(FEATURES)}


def nodes_of(text: str) -> Nodes:
    spans, features, edges, seen = [], [], [], {}
    if not _MARK.search(text):
        return Nodes(spans, features, edges)
    for m in _TOKEN.finditer(text):
        token = m[0]
        if not _MARK.search(token):
            continue
        core = token.strip(".,;:!?\"'<>[]{}|")
        start = m.start() + token.find(core) if core else m.start()
        core = core or token
        i = len(spans)
        spans.append((start, start + len(core)))
        digits = "".join(_DIGIT.findall(core))
        on = ["bias"]
        on += ["at"] * ("@" in core)
        dots = min(core.count("."), 3)
        on += [f"dot{dots}"] * (dots > 0)
        for name, mark in (
            ("dash", "-"), ("open", "("), ("close", ")"), ("plus", "+"),
            ("equals", "="), ("quote", '"'), ("colon", ":"),
        ):
            on += [name] * (mark in core)
        on += ["lower"] * any(c.islower() for c in core)
        on += ["upper"] * any(c.isupper() for c in core)
        on += [f"digits{len(digits)}" if len(digits) < 20 else "longer"] * bool(digits)
        on += ["pure"] * (digits == core)
        on += ["groups"] * bool(re.search("[0-9][^0-9]+[0-9]", core))
        features.append([_AT[x] for x in on])
        if i:
            near = start - spans[i - 1][1] <= 2
            edges.append((i - 1, i, 0 if near else 1))
            if near:
                features[i].append(_AT["near_before"])
                features[i - 1].append(_AT["near_after"])
                if _AT["plus"] in features[i - 1]:
                    features[i].append(_AT["plus_before"])
        # Edges to the first and the last occurrence, so that a token repeated very
        # often gives as many edges as occurrences, and each hears of the first.
        keys = {("token", core.casefold())}
        if len(digits) >= 7:
            keys.add(("digits", digits))
            keys.add(("digits", digits[-7:]))
        if "@" in core and len(core.split("@")[0]) >= 4:
            keys.add(("token", core.split("@")[0].casefold()))
        for earlier in {j for k in keys for j in seen.get(k, ())}:
            edges.append((earlier, i, 2))
        for k in keys:
            seen[k] = (seen[k][0] if k in seen else i, i)
    return Nodes(spans, features, edges)


def _matrix(features: list[list[int]]) -> np.ndarray:
    x = np.zeros((len(features), len(FEATURES)))
    for i, on in enumerate(features):
        x[i, on] = 1
    return x


def _soft(scores: np.ndarray) -> np.ndarray:
    top = np.exp(scores - scores.max(axis=1, keepdims=True))
    return top / top.sum(axis=1, keepdims=True)


def _labels(spans: list[tuple[int, int]], base: list[Span]) -> list[int]:
    """The kind of the first pattern that overlaps each node."""
    out, at = [NONE] * len(spans), 0
    for start, kind, end in base:
        while at and spans[at - 1][1] > start:
            at -= 1
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        k = at
        while k < len(spans) and spans[k][0] < end:
            out[k] = min(out[k], kind)
            k += 1
    return out


def _like_known(edges: np.ndarray, known: np.ndarray) -> np.ndarray:
    """For each node the label of the first known node that skip edges lead to, over any
    number of steps; NONE without one."""
    head = list(range(len(known)))

    def root(i: int) -> int:
        while head[i] != i:
            head[i] = head[head[i]]
            i = head[i]
        return i

    for i, j, kind in edges.tolist():
        if kind == 2:
            a, b = root(i), root(j)
            head[max(a, b)] = min(a, b)
    label: dict[int, int] = {}
    for i in np.flatnonzero(known != NONE).tolist():
        label.setdefault(root(i), int(known[i]))
    return np.array([label.get(root(i), NONE) for i in range(len(known))], np.int64)


def _tied(gap: np.ndarray) -> np.ndarray:
    """Gradients of skip potentials that are one for all kinds: equal kinds, different
    kinds, a kind and none, none and none."""
    kinds, same = np.arange(NONE), np.eye(NONE, dtype=bool)
    out = gap.copy()
    out[kinds, kinds] = gap[:NONE, :NONE][same].sum()
    inner = out[:NONE, :NONE]
    inner[~same] = gap[:NONE, :NONE][~same].sum()
    out[:NONE, NONE] = out[NONE, :NONE] = gap[:NONE, NONE].sum() + gap[NONE, :NONE].sum()
    return out


@dataclass
class Field:
    """Unary weights (features x labels) and pair potentials (3 x labels x labels)."""

    unary: np.ndarray
    pair: np.ndarray

    @staticmethod
    def fit(texts: Iterable[str], steps: int = FIT_STEPS) -> Field:
        """Pseudo-likelihood: each label given the labels of its neighbours.

        Tokens are seen with their own and their neighbours' shapes; a small
        penalty keeps the weights finite. A token that no pattern covers but that a
        skip edge joins to a covered one has no label, neither for itself nor for its
        neighbours. Skip potentials are the same for all kinds. Without any node the
        field is flat.
        """
        count = NONE + 1
        field = Field(np.zeros((len(FEATURES), count)), np.zeros((3, count, count)))
        features, labels, edges = [], [], []
        for text in texts:
            nodes = nodes_of(text)
            base = len(labels)
            labels += _labels(nodes.spans, base_spans(text))
            features += nodes.features
            edges += [(base + i, base + j, t) for i, j, t in nodes.edges]
        if not labels:
            return field
        x, y = _matrix(features), np.array(labels)
        u, v, kind = np.array(edges, np.int64).reshape(-1, 3).T
        hot = np.eye(count)[y]
        skip = kind == 2
        open_ends = np.zeros(len(y), bool)
        open_ends[u[skip][(y[u[skip]] == NONE) & (y[v[skip]] != NONE)]] = True
        open_ends[v[skip][(y[v[skip]] == NONE) & (y[u[skip]] != NONE)]] = True
        told = ~open_ends
        hot[open_ends] = 0
        around = np.zeros((3, len(y), count))
        np.add.at(around, (kind, u), hot[v])
        np.add.at(around, (kind, v), hot[u])
        rows = np.concatenate([x, *around], axis=1)
        # Shapes alone explain the patterns' labels. So each token with a labelled one
        # like it counts once more by that one only: this is what skip potentials weigh.
        alike = np.zeros_like(rows)
        alike[:, -count:] = around[2]
        more = told & (around[2].sum(axis=1) > 0)
        rows = np.concatenate([rows[told], alike[more]])
        hot = np.concatenate([hot[told], hot[more]])
        weights = np.zeros((rows.shape[1], count))
        memory = np.full_like(weights, 1e-8)
        penalty = np.full((len(weights), 1), PENALTY)
        penalty[-count:] = SKIP_PENALTY
        for _ in range(steps):
            gap = rows.T @ (_soft(rows @ weights) - hot) / len(rows) + penalty * weights
            gap[-count:] = _tied(gap[-count:])
            memory += gap * gap
            weights -= 0.5 * gap / np.sqrt(memory)
        field.unary = weights[: len(FEATURES)]
        pair = weights[len(FEATURES) :].reshape(3, count, count)
        field.pair = (pair + pair.transpose(0, 2, 1)) / 2
        return field

    def marginals(
        self, x: np.ndarray, edges: np.ndarray, known: np.ndarray | None = None
    ) -> np.ndarray:
        """Beliefs of loopy propagation when its messages have settled. ``known`` holds
        the labels of nodes that are known, and NONE for the others."""
        unary = x @ self.unary
        if known is not None:
            sure = np.flatnonzero(known != NONE)
            unary[sure] = 0
            unary[sure, known[sure]] = KNOWN
        if not len(edges):
            return _soft(unary)
        u, v, kind = edges.T
        source, target = np.concatenate([u, v]), np.concatenate([v, u])
        reverse = np.concatenate([np.arange(len(u)) + len(u), np.arange(len(u))])
        pair = self.pair[np.concatenate([kind, kind])]
        messages = np.zeros((len(source), NONE + 1))
        if known is not None:
            # What is known has reached the tokens like it before the others speak: many
            # copies of a token would else hold each other to their shape.
            like = _like_known(edges, known)
            reached = (np.concatenate([kind, kind]) == 2) & (like[source] != NONE)
            messages[reached] = self.pair[2][like[source[reached]]]
            messages -= messages.max(axis=1, keepdims=True)
        turn = 0
        while True:
            turn += 1
            belief = unary.copy()
            np.add.at(belief, target, messages)
            out = (belief[source] - messages[reverse])[:, :, None] + pair
            top = out.max(axis=1)
            new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - messages).max()
            messages += 0.5 * min(1.0, FULL_STEPS / turn) * (new - messages)
            # Later steps are small, so that what is left to change counts less.
            if change * min(1.0, FULL_STEPS / turn) ** 2 <= SETTLED:
                break
        belief = unary
        np.add.at(belief, target, messages)
        return _soft(belief)

    def spans(self, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        """Base spans and all spans of each text."""
        base = [base_spans(t) for t in texts]
        nodes = [nodes_of(t) for t in texts]
        counts = [len(n.spans) for n in nodes]
        if not sum(counts):
            return [(b, b) for b in base]
        shift = np.cumsum(counts) - counts
        edges = np.array(
            [(s + i, s + j, t) for s, n in zip(shift, nodes, strict=True) for i, j, t in n.edges],
            np.int64,
        ).reshape(-1, 3)
        covers = [_labels(n.spans, b) for n, b in zip(nodes, base, strict=True)]
        known = np.array([k for c in covers for k in c])
        beliefs = self.marginals(
            _matrix([f for n in nodes for f in n.features]), edges, known
        )
        best = beliefs.argmax(axis=1)
        alike = _like_known(edges, known) != NONE
        best[beliefs.max(axis=1) < np.where(alike, ALIKE, ADDED)] = NONE
        out = []
        for b, n, s, covered in zip(base, nodes, shift.tolist(), covers, strict=True):
            added: list[list[int]] = []
            before = -2
            for i, (start, end) in enumerate(n.spans):
                kind = int(best[s + i])
                if kind == NONE or covered[i] != NONE:
                    continue
                joins = before == i - 1 and start - n.spans[i - 1][1] <= 2
                if joins and added[-1][1] == kind:
                    added[-1][2] = end
                else:
                    added.append([start, kind, end])
                before = i
            out.append((b, sorted([*b, *map(tuple, added)])))
        return out


def fit_field(
    docs: DataFrame, text: str = "text", documents: int = FIT_DOCUMENTS
) -> Field:
    """A field fitted to a bounded sample of texts that hold a digit or at sign:
    about ``documents`` of them, those of the smallest hashes, of at most
    ``FIT_CHARS`` characters. Copies of a text are sampled as one."""
    whole = quoted(text)
    some = docs.filter(whole.rlike("[0-9@]") & (F.length(whole) <= FIT_CHARS))
    rows = some.select(whole.alias("t"), F.pmod(F.xxhash64("t"), F.lit(HASHES)).alias("h"))
    # Texts are as many as their hashes, near enough.
    count = rows.agg(F.approx_count_distinct("h")).first()[0]
    share = HASHES if count <= documents else HASHES * documents // count
    sample = rows.filter(F.col("h") < share).select("t").distinct().orderBy("t")
    return Field.fit(r["t"] for r in sample.collect())


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; spans that overlap are one."""
    out, upto = [], 0
    for start, kind, end in spans:
        if start >= upto:
            out += [text[upto:start], f"[{KINDS[kind].upper()}]"]
        upto = max(upto, end)
    return "".join([*out, text[upto:]])


FOUND = (
    "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
    "base_sha256 string, spans string"
)


def find_personal_data(
    docs: DataFrame, field: Field, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: pattern counts, the digest of the pattern spans, all spans.

    A null text is empty and has none; doc_id may be null or repeat; other
    columns are not read.
    """
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rechunked(batches, "_text", CHUNK_BYTES):
            found = field.spans(text_column(batch, "_text").to_pylist())
            counts = [
                pa.array([sum(k == i for _, k, _ in b) for b, _ in found], pa.int64())
                for i in range(len(KINDS))
            ]
            digests = [hashlib.sha256(written(b).encode()).hexdigest() for b, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("_doc")),
                    *counts,
                    pa.array(digests, pa.string()),
                    pa.array([written(s) for _, s in found], pa.string()),
                ],
                names,
            )

    rows = docs.select(quoted(doc).cast("bigint").alias("_doc"), quoted(text).alias("_text"))
    return rows.mapInArrow(run, f"doc_id bigint, {FOUND}")


def redact(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """The rows with every span in the text replaced; null texts stay null. All
    other columns are kept as they are."""
    schema = docs.schema
    at = [f.name for f in schema.fields].index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rechunked(batches, text, CHUNK_BYTES):
            texts = batch.column(at).to_pylist()
            found = field.spans([t or "" for t in texts])
            new = [
                t if t is None else redacted(t, s)
                for t, (_, s) in zip(texts, found, strict=True)
            ]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, schema)
