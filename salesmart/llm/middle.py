"""Fill-in-middle transformation over an indexable skip list (operator 11).

A text is a row of units: white space and the run behind it, or white space at
the very end. ``SkipList`` links the units: the lowest lane joins neighbours,
and every node of a lane rises into the next one with a chance of 1 in 4, by a
hash of its number alone. Each link carries how many units and how many code
points it passes. A cut at unit ``r`` is found from the top lane down, taking
every link that doesn't pass ``r`` and adding up both widths, so the code
points before the cut are known after O(log n) links.

Both cuts and the form come from the SHA-256 of ``seed:doc_id``, so a rerun, or
a rerun of one lost task, writes the same rows. ``restore`` undoes a form.

Null text: empty, which stays plain. Null id: hashed as an empty id. Repeated
rows are cut alike; rows that share an id share its hash. A text that holds a
mark of its own stays plain, so that the marks of an output are never in doubt.
An empty table gives no rows. A task holds a slice of texts, or one long text
with about 3 bytes of links per byte of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import id_and_text, slices

MARKS = ("<P>", "<S>", "<M>")
RATE, SPM_RATE, SEED = 50, 80, 42
_RISE = 2  # bits of a node's hash that must be zero for each lane it rises
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def unit_widths(raw: np.ndarray) -> np.ndarray:
    """Code points of each unit of a text, from its UTF-8 bytes."""
    if not len(raw):
        return np.zeros(0, np.int64)
    space = _SPACE[raw]
    ends = np.append(np.flatnonzero(~space[:-1] & space[1:]) + 1, len(raw))
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return np.diff(points[ends], prepend=0)


class SkipList:
    """Units in order, with express lanes; each link holds the units and the code points it passes.

    ``lanes[k]`` lists lane k's nodes by their index in the lane below (lane 0: the
    unit's number). The link of slot i goes to node i; a last link goes to the end.
    """

    def __init__(self, widths: np.ndarray):
        self.n = len(widths)
        height = _rises(self.n)
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        units, points = np.ones(self.n, np.int64), np.asarray(widths, np.int64)
        down = np.arange(self.n)
        while True:
            self.lanes.append((down, units, points))
            up = np.flatnonzero(height[self._numbers()] >= len(self.lanes))
            if not len(up) or len(up) == len(down):
                break
            total = [np.concatenate([[0], np.cumsum(w)]) for w in (units, points)]
            # The link to a risen node passes all that lies between it and the risen node before.
            units, points = (np.diff(t[up + 1], prepend=0) for t in total)
            down = up

    def _numbers(self) -> np.ndarray:
        """The unit numbers of the top lane's nodes."""
        at = self.lanes[-1][0]
        for down, _, _ in reversed(self.lanes[:-1]):
            at = down[at]
        return at

    def seek(self, rank: int) -> tuple[int, int]:
        """(units, code points) of the first ``rank`` units, by descent; at most all units."""
        passed = points = 0
        slot = 0  # the next link to try in this lane
        for level in range(len(self.lanes) - 1, -1, -1):
            down, units, widths = self.lanes[level]
            while slot < len(units) and passed + units[slot] <= rank:
                passed, points, slot = passed + int(units[slot]), points + int(widths[slot]), slot + 1
            if level:  # the same place one lane lower: behind the node whose link was taken last
                slot = int(down[slot - 1]) + 1 if slot else 0
        return passed, points


def _rises(n: int) -> np.ndarray:
    """Lanes each of ``n`` nodes rises: zero bits at the end of a hash of its number, two a lane."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    low = x & (~x + np.uint64(1))
    zeros = np.where(low == 0, 64, np.log2(np.maximum(low, 1).astype(np.float64)))
    return (zeros // _RISE).astype(np.int64)


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in range(0, 32, 8))


def transform_text(text: str, doc_id: int | None, rate: int = RATE, spm_rate: int = SPM_RATE,
                   seed: int = SEED) -> tuple[str, str, int, int | None, int | None]:
    """(output, form, units, code points of the prefix, of the middle)."""
    links = SkipList(unit_widths(np.frombuffer(text.encode(), np.uint8)))
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= rate or any(m in text for m in MARKS):
        return text, "plain", links.n, None, None
    first, last = sorted((h1 % (links.n + 1), h2 % (links.n + 1)))
    a, b = links.seek(first)[1], links.seek(last)[1]
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = MARKS
    if h4 % 100 < spm_rate:
        return f"{s}{suffix}{p}{prefix}{m}{middle}", "spm", links.n, a, b - a
    return f"{p}{prefix}{s}{suffix}{m}{middle}", "psm", links.n, a, b - a


def restore(output: str, form: str) -> str:
    """The text that ``transform_text`` made ``output`` from."""
    if form == "plain":
        return output
    p, s, m = MARKS
    first, second = (s, p) if form == "spm" else (p, s)
    head, _, middle = output.partition(m)
    one, _, two = head.removeprefix(first).partition(second)
    return two + middle + one if form == "spm" else one + middle + two


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = RATE,
                   spm_rate: int = SPM_RATE, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n (units), form, prefix_chars, middle_chars, output and the text
    restored from it. ``rate`` percent are cut, ``spm_rate`` percent of these suffix first."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            ids, texts = rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()
            done = [transform_text(t, i, rate, spm_rate, seed) for i, t in zip(ids, texts, strict=True)]
            output, form, n, prefix, middle = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.string()),
                 pa.array(map(restore, output, form), pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        cut, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string")


def digests(cut: DataFrame) -> DataFrame:
    """The rows of ``fill_in_middle`` with SHA-256 sums in place of the texts."""
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


_GROUP = "CAST('0x' || substr(h, {}, 8) AS BIGINT)"
ORACLE_SQL = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
cut AS (SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM texts),
ranks AS (SELECT *, len(u) AS n, {_GROUP.format(1)} % (len(u) + 1) AS a, {_GROUP.format(9)} % (len(u) + 1) AS b,
                 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {_GROUP.format(17)} % 100 >= {RATE} THEN 'plain'
                      WHEN {_GROUP.format(25)} % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (SELECT *, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
                 array_to_string(u[greatest(a, b) + 1:], '') AS s FROM ranks)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
