"""Fill-in-middle transformation with a sparse index of the characters beyond ASCII.

A text is cut into n units: words, each with the white space before it and white space at the end as a unit of
its own, or code points. Numbers h1 to h4 are the first four groups of eight digits of the SHA-256 of
`seed:doc_id`. The prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1) units, the middle after the
larger, the suffix is the rest. h3 decides whether a text is changed at all, h4 whether the suffix goes first.

Texts are handled as the UTF-8 bytes of an Arrow batch. The index of a block keeps the byte position of every
character of more than one byte and the running sum of its excess bytes. A byte cut before which e excess
bytes lie is at code point `byte - e`, and the other way round, so one `searchsorted` in the short index
converts all cuts of a block, and spans of ASCII need no look at their bytes. No text is decoded.

A null or empty text, and one that holds a sentinel, stays plain: output is the text (a null one is empty), and
`prefix_chars` and `middle_chars` are null. A null doc_id is hashed as no digits. Every input row gets one
row, repeated rows alike; further columns of the input are not read. A text of any length is one value; tasks
hold a few megabytes beside their longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from patronage.llm.text import IS_SPACE, blocks, column_bytes, word_spans

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FORMS = np.array(["plain", "psm", "spm"])


@dataclass
class ExceptionIndex:
    """Byte positions of the multibyte characters of a buffer and the excess bytes up to and with each."""

    at: np.ndarray
    excess: np.ndarray

    @classmethod
    def of(cls, raw: np.ndarray) -> ExceptionIndex:
        at = np.flatnonzero(raw >= 0xC0)
        lead = raw[at]
        return cls(at, np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0), dtype=np.int64))

    def chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before byte cuts that lie between characters."""
        k = np.searchsorted(self.at, cuts)
        return cuts - np.where(k > 0, self.excess[np.maximum(k - 1, 0)], 0) if len(self.at) else cuts

    def bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before cuts given in code points."""
        if not len(self.at):
            return cuts
        # code point number of each exception: its byte position less the excess before it
        own = self.at - np.concatenate([[0], self.excess[:-1]])
        k = np.searchsorted(own, cuts)
        return cuts + np.where(k > 0, self.excess[np.maximum(k - 1, 0)], 0)


def _draws(ids: list, seed: int) -> np.ndarray:
    """h1 to h4 of every id."""
    digests = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(digests, dtype=">u4").reshape(-1, 4).astype(np.int64)


def _held(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether a row holds a sentinel."""
    if len(raw) < 3:
        return np.zeros(len(offsets) - 1, dtype=bool)
    middle = raw[1:-1]
    hits = np.flatnonzero((raw[:-2] == ord("<")) & (raw[2:] == ord(">")) & ((middle == ord("P")) | (middle == ord("S")) | (middle == ord("M"))))
    row = np.searchsorted(offsets, hits, "right") - 1
    row = row[hits + 3 <= offsets[row + 1]]
    return np.bincount(row, minlength=len(offsets) - 1).astype(bool)


def _word_units(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of every row, ends of the words, and the first word of each row."""
    _, ends, first = word_spans(raw, offsets)
    filled = np.diff(offsets) > 0
    tail = np.zeros(len(filled), dtype=bool)
    tail[filled] = IS_SPACE[raw[offsets[1:][filled] - 1]]
    return np.diff(first) + tail, ends, first


def transform_block(raw: np.ndarray, offsets: np.ndarray, draws: np.ndarray, unit: str, rate: int, suffix_first: int):
    """Units, form, the two byte cuts in the buffer and the two lengths in code points, per row."""
    low, high = offsets[:-1], offsets[1:]
    index = ExceptionIndex.of(raw)
    starts = index.chars(offsets)
    if unit == "words":
        n, ends, first = _word_units(raw, offsets)
    else:
        n = np.diff(starts)
    drawn = draws[:, :2] % (n + 1)[:, None]
    cuts = np.stack([drawn.min(axis=1), drawn.max(axis=1)], axis=1)
    if unit == "words":
        ends = np.append(ends, len(raw))
        at = np.minimum(first[:-1, None] + cuts - 1, len(ends) - 1)
        places = np.where(cuts == 0, low[:, None], np.where(cuts == n[:, None], high[:, None], ends[np.maximum(at, 0)]))
        points = index.chars(places)
    else:
        points = starts[:-1, None] + cuts
        places = index.bytes(points)
    plain = (n == 0) | _held(raw, offsets) | (draws[:, 2] % 100 >= rate)
    form = np.where(plain, 0, np.where(draws[:, 3] % 100 < suffix_first, 2, 1))
    return n, form, places, points[:, 0] - starts[:-1], points[:, 1] - points[:, 0]


def fill_in_middle(documents: DataFrame, seed: int = 42, unit: str = "words", rate: int = 50, suffix_first: int = 80) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the transformed text of every row.

    `rate` of a hundred texts are changed, `suffix_first` of a hundred of these have the suffix in front;
    `unit` is "words" or "characters".
    """
    if unit not in ("words", "characters"):
        raise ValueError(f"unit is words or characters, not {unit}")
    prefix, suffix, middle = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            for a, b, part, places in blocks(raw, offsets):
                ids = batch.column(0).slice(a, b - a)
                n, form, cuts, head, body = transform_block(part, places, _draws(ids.to_pylist(), seed), unit, rate, suffix_first)
                view = part.tobytes()
                out = []
                for f, s, p, q, e in zip(form.tolist(), places[:-1].tolist(), cuts[:, 0].tolist(), cuts[:, 1].tolist(), places[1:].tolist()):
                    if f == 0:
                        out.append(view[s:e])
                    elif f == 1:
                        out.append(b"".join((prefix, view[s:p], suffix, view[q:e], middle, view[p:q])))
                    else:
                        out.append(b"".join((suffix, view[q:e], prefix, view[s:p], middle, view[p:q])))
                changed = pa.array(form == 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(n.astype(np.int64)),
                        pa.array(FORMS[form], pa.string()),
                        pa.array(head.astype(np.int64), mask=np.asarray(changed)),
                        pa.array(body.astype(np.int64), mask=np.asarray(changed)),
                        pa.array(out, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return documents.select("doc_id", "text").mapInArrow(cut, schema)


def restored(form, output):
    """The text from which an output was made; columns or column names.

    A changed text holds no sentinel of its own, and none can arise at a seam, so the output has three.
    """
    form, output = (F.col(c) if isinstance(c, str) else c for c in (form, output))
    parts = F.split(output, "<[PSM]>", -1)
    order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    text = output
    for name, places in order.items():
        text = F.when(form == name, F.concat(*(parts[i] for i in places))).otherwise(text)
    return text


ORACLE = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
drawn AS (
  SELECT doc_id, text, units, len(units) AS n,
    ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM cut),
parts AS (
  SELECT doc_id, text, n,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
         WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(units[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
    array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
    array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:n], '') AS suffix
  FROM drawn)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
