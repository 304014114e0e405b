"""License notices in texts, exact and with typing errors.

A notice is a row of segments, each with the number of edits (inserted, deleted or
replaced characters) that it may hold. A segment with e edits, cut in e + 1 pieces,
keeps at least one piece unchanged, so the places of the pieces of one segment of a
notice locate all its candidates. Around them the ``regex`` library matches the whole
notice with its segments' bounds, and the best span of each place is kept.

Words are what stands between ASCII characters other than letters and digits; texts
are compared as lower-case words with one space between them, so case, punctuation and
line breaks do not count as edits. A span starts and ends with a whole word.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from prefshare.functions.flags import quoted
from prefshare.llm.common import rechunked, text_column

CHUNK_BYTES = 4 << 20
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@dataclass(frozen=True)
class Notice:
    """``segments`` hold (words, edits). Texts of segments follow each other as they
    are; the words that tell licenses apart have few edits or none."""

    label: str
    segments: tuple[tuple[str, int], ...]

    @property
    def text(self) -> str:
        return "".join(text for text, _ in self.segments)

    @cached_property
    def seeds(self) -> tuple[tuple[str, int, int], ...]:
        """(piece, least, most): the pieces of the segment whose shortest piece is the
        longest, and how far the notice may begin before each."""
        best, before, slack = (), 0, 0
        for text, edits in self.segments:
            cuts = [len(text) * i // (edits + 1) for i in range(edits + 2)]
            pieces = [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            if not best or min(map(len, pieces)) > min(len(p) for p, *_ in best):
                best = tuple(
                    (p, before + a, slack + edits) for p, a in zip(pieces, cuts, strict=False)
                )
            before, slack = before + len(text), slack + edits
        return best

    @cached_property
    def pattern(self) -> regex.Pattern:
        body = "".join(
            f"(?:{regex.escape(text)}){{e<={edits}}}" if edits else f"(?:{regex.escape(text)})"
            for text, edits in self.segments
        )
        # The best match: the one with the fewest edits. It is tried at given starts, as
        # a search never begins with an inserted character.
        return regex.compile(f"(?:{body})(?![^ ])", regex.BESTMATCH | regex.V1)

    @property
    def edits(self) -> int:
        return sum(edits for _, edits in self.segments)


# Phrases that are found as they are, word by word.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
NOTICES = (
    Notice("mit", (("under the ", 1), ("mit", 1), (" license", 1))),
    Notice("mit", (("permission is hereby granted free of charge to any person obtaining a copy", 6),)),
    Notice("apache-2", (("apache license", 2), (" version ", 1), ("2", 0))),
    Notice("apache-2", (("apache license", 2), (" v2", 0))),
    Notice("cc-by-nc", (("cc", 0), (" by", 1), (" nc", 0))),
    Notice("cc-by-nc", (("creative commons attribution noncommercial", 4),)),
    Notice("cc-by-sa", (("cc", 0), (" by", 1), (" sa", 0))),
    Notice("cc-by-sa", (("creative commons attribution sharealike", 4),)),
    Notice("gpl", (("gnu general public license", 3),)),
    Notice("lgpl", (("gnu lesser general public license", 3),)),
    Notice("agpl", (("gnu affero general public license", 3),)),
    Notice("mpl-2", (("mozilla public license", 2), (" version ", 1), ("2", 0))),
    Notice("bsd", (("redistribution and use in source and binary forms", 4),)),
    Notice("public-domain", (("dedicated to the public domain", 2),)),
)


def normal(text: str) -> list[str]:
    """The words; only A to Z are folded."""
    return WORD.findall(text.encode().lower().decode())


def places(padded: str, phrase: str) -> list[int]:
    """Numbers of the words at which the phrase begins, in words with a space around
    each."""
    found, at, upto, words = [], padded.find(phrase), 0, 0
    while at >= 0:
        words += padded.count(" ", upto, at)
        upto = at
        found.append(words)
        at = padded.find(phrase, at + 1)
    return found


def starts_of(words: str, notice: Notice) -> list[int]:
    """Starts of the words at which the notice may begin: one piece stands unchanged as
    far behind as its own edits allow."""
    found: set[int] = set()
    for piece, before, shift in notice.seeds:
        at = words.find(piece)
        while at >= 0:
            lo, hi = at - before - shift, at - before + shift
            if lo <= 0 <= hi:
                found.add(0)
            lo = words.find(" ", max(lo - 1, 0), hi)
            while lo >= 0:
                found.add(lo + 1)
                lo = words.find(" ", lo + 1, hi)
            at = words.find(piece, at + 1)
    return sorted(found)


def spans(words: str, notice: Notice) -> list[tuple[int, int, int]]:
    """(start, end, edits) of the notice in the words, in order and without overlap;
    of spans that overlap the one with the fewest edits, then the first."""
    found, longest = [], len(notice.text) + notice.edits
    for start in starts_of(words, notice):
        upto = words.find(" ", start + longest)
        match = notice.pattern.match(words, start, len(words) if upto < 0 else upto)
        if match is not None:
            found.append((sum(match.fuzzy_counts), start, match.end()))
    kept: list[tuple[int, int, int]] = []
    for edits, start, end in sorted(found):
        at = bisect(kept, (start, end, edits))
        if (not at or kept[at - 1][1] <= start) and (at == len(kept) or end <= kept[at][0]):
            kept.insert(at, (start, end, edits))
    return kept


def _places_in_text(text: str, words: str, found: list[tuple]) -> list[dict]:
    """The spans with the code points they take in the text itself."""
    ends = [(m.start(), m.end()) for m in WORD.finditer(text.encode().lower().decode())]
    return [
        {
            "label": label,
            "start": (start := ends[words.count(" ", 0, lo)][0]),
            "end": (end := ends[words.count(" ", 0, hi)][1]),
            "edits": edits,
            "text": text[start:end],
        }
        for label, lo, hi, edits in found
    ]


def scan(
    text: str, phrases: dict[str, str], notices: Sequence[Notice]
) -> dict[str, object]:
    """One text's row, see ``scan_licenses``."""
    split = normal(text)
    words = " ".join(split)
    padded = f" {words} "
    base, labels, starts, count = set(), set(), [], 0
    for phrase, label in phrases.items():
        some = places(padded, f" {phrase} ")
        if some:
            base.add(label)
            count += len(some)
            starts += [some[0], some[-1]]
    found, score = [], 1.0 if base else 0.0
    for notice in notices:
        for lo, hi, edits in spans(words, notice):
            found.append((notice.label, lo, hi, edits))
            score = max(score, 1.0 - edits / len(notice.text))
    labels = base | {label for label, *_ in found}
    return {
        "n_words": len(split),
        "n_base": count,
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(labels)),
        "score": score,
        "spans": _places_in_text(text, words, sorted(found, key=lambda x: (x[1], x[2], x[0])))
        if found
        else [],
    }


SPANS = "array<struct<label string, start bigint, end bigint, edits int, text string>>"
ROW = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    f"base_labels string, labels string, score double, spans {SPANS}"
)
_SPAN = pa.struct(
    [
        ("label", pa.string()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("edits", pa.int32()),
        ("text", pa.string()),
    ]
)
_FIELDS = [
    ("n_words", pa.int64()),
    ("n_base", pa.int64()),
    ("first_word", pa.int64()),
    ("last_word", pa.int64()),
    ("base_labels", pa.string()),
    ("labels", pa.string()),
    ("score", pa.float64()),
    ("spans", pa.list_(_SPAN)),
]


def _scanned(phrases: dict[str, str], notices: Sequence[Notice]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rechunked(batches, "_text", CHUNK_BYTES):
            rows = [scan(t, phrases, notices) for t in text_column(batch, "_text").to_pylist()]
            columns = [pa.array([r[name] for r in rows], kind) for name, kind in _FIELDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["doc_id", *[name for name, _ in _FIELDS]]
            )

    return run


def scan_licenses(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    phrases: dict[str, str] | None = None,
    notices: Sequence[Notice] = NOTICES,
) -> DataFrame:
    """Per document: doc_id, n_words, n_base (places of the phrases), first_word and
    last_word (the smallest and largest of them), base_labels (of phrases), labels (of
    notices, too), score (1 where a phrase or notice stands as it is, less by edits for
    each character of the notice, 0 without any) and spans (label, code points, edits,
    text) of the notices.

    Each document is scanned by itself, whole, without a shuffle. A null text is empty:
    no words, no labels (empty strings), null first and last words. Rows with a null or
    repeated doc_id are rows like any other; other columns are not read. An empty table
    gives no rows.
    """
    rows = docs.select(quoted(doc).cast("bigint").alias("doc_id"), quoted(text).alias("_text"))
    return rows.mapInArrow(
        _scanned(dict(PHRASES if phrases is None else phrases), tuple(notices)),
        f"doc_id bigint, {ROW}",
    )
