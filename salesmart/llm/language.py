"""Language identification by cross-parsing (operator 6).

A suffix automaton of a language's labelled text accepts its substrings. A
text is parsed greedily against it: every phrase is the longest match from
where the last one ended, or one unseen letter. Text in the language needs few
phrases; phrases x log2(training length) / length estimates the cross entropy,
and the language with the least wins.

Training reads a bounded sample (``sample_documents`` per language, and
``sample_chars`` characters of them, the same for each language whatever their
number) of labelled rows that are not held out; it is the only thing on the
driver. Every letter of the sample has a code of its own. Each worker builds the
automata once, as one sparse table (rows of transitions laid into each other's
gaps; memory follows the letters learned), and steps all texts of a slice
through all languages together. Whole texts are parsed; stretches of ``STRETCH``
letters run side by side, so one very long text is many lanes, and the state is
carried from each into the next, so the phrases are those of one parse.

Memory of a worker: about 70 bytes for every letter learned, that is 4 MB a
language (of 60,000 characters), and the states of a slice of texts, 6 bytes a
letter and language. With L languages the closure holds L samples of 60 KB and up.

Letters are lower-cased; runs of anything else are one separator. Null text or
one without letters is ``und`` with score 0, as is everything if no row is
labelled. Ties go to the first language by code point. A null id is never held
out. The score is 1 - (least / second least) entropy (1 with one language).
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import id_and_text, per_process, resident, slices

SAMPLE_DOCUMENTS, SAMPLE_CHARS = 300, 60_000
PIECES = 8
STRETCH = 512
SLICE_BYTES = 1 << 20
FEW = 16  # stretches that are stepped one by one rather than together
_CODE_BITS = 21
UNKNOWN = "und"


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string")) % 4 == 2, F.lit(False))


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text, 0 for what is no letter, runs of 0 as one."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    points = np.where(per_process("letters", lambda: np.array(
        [chr(c).isalpha() for c in range(0x110000)]))[points], points, 0)
    return points[(points != 0) | (np.append(1, points[:-1]) != 0)]


def _automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``codes``, by state; 0 is the root."""
    to: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(to)
        to.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in to[p]:
            to[p][c] = new
            p = link[p]
        if p >= 0:
            q = to[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(to)
                to.append(dict(to[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and to[p].get(c) == q:
                    to[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return to


def _laid(rows: list[dict[int, int]], taken: bytearray, r: random.Random) -> list[int]:
    """A place for each row so that no two entries (place + code) meet and no two places are equal."""
    at, used = [0] * len(rows), set()
    for i in sorted(range(len(rows)), key=lambda i: -len(rows[i])):
        codes = rows[i]
        while (p := int(r.random() * len(taken))) in used or any(
                p + c < len(taken) and taken[p + c] for c in codes):
            pass
        used.add(p)
        at[i] = p
        if codes and (more := p + max(codes) + 1 - len(taken)) > 0:
            taken.extend(bytes(more))
        for c in codes:
            taken[p + c] = 1
    return at


class Model:
    """Automata of all languages as one sparse table. A state is a place; its transition for a code is the entry at
    place + code, if that holds the code (next place << _CODE_BITS | code). The roots' transitions stand apart."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        points = {k: _letters(samples[k]) for k in self.languages}
        known = np.unique(np.concatenate([np.zeros(1, np.uint32), *points.values()]))
        self.width = len(known) + 1  # 0: separator, the last: letters of no sample
        self.code = np.full(0x110000, self.width - 1, np.int32)
        self.code[known] = np.arange(len(known))
        self.roots, self.bits = [], []
        self.starts = np.empty((len(self.languages), self.width), np.int64)
        r = random.Random(0)
        parts, first = [], 0
        for i, k in enumerate(self.languages):
            to = _automaton(self.code[points[k]].tolist())
            rows = [{}, *to[1:]]
            taken = bytearray(max(2 * sum(map(len, rows)), 2 * len(rows)) + 1)
            at = np.array(_laid(rows, taken, r), np.int64)
            part = np.full(len(taken) + self.width, (1 << _CODE_BITS) - 1, np.int64)
            lengths = np.fromiter(map(len, rows), np.int64, len(rows))
            total = int(lengths.sum())
            codes = np.fromiter((c for row in rows for c in row), np.int64, total)
            nexts = np.fromiter((s for row in rows for s in row.values()), np.int64, total)
            part[np.repeat(at, lengths) + codes] = (at[nexts] + first) << _CODE_BITS | codes
            self.starts[i] = at[0] + first
            self.starts[i, list(to[0])] = at[list(to[0].values())] + first
            self.roots.append(int(at[0]) + first)
            self.bits.append(np.log2(max(2, len(points[k]))))
            parts.append(part)
            first += len(part)
        self.table = np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(languages x texts) bits a letter, and whether a text has letters."""
        codes = [self.code[_letters(t)] for t in texts]
        lengths = np.array([len(c) for c in codes], np.int64)
        real = np.array([bool((c != 0).any()) for c in codes])
        # Stretches of all texts are lanes, longest first; step t takes the lanes longer than t.
        counts = -(-lengths // STRETCH)
        text_of = np.repeat(np.arange(len(texts)), counts)
        first = np.arange(len(text_of)) - np.repeat(np.cumsum(counts) - counts, counts)
        size = np.minimum(STRETCH, lengths[text_of] - first * STRETCH)
        begin = np.repeat(np.cumsum(lengths) - lengths, counts) + first * STRETCH
        flat = np.concatenate([*codes, np.zeros(STRETCH, np.int32)])
        phrases = self._phrases(flat, begin, size, first > 0)
        total = np.zeros((len(self.languages), len(texts)))
        for i in range(len(self.languages)):
            total[i] = np.bincount(text_of, weights=phrases[i], minlength=len(texts)) * self.bits[i]
        return total / np.maximum(1, lengths), real

    def _step(self, state: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after ``letter``, and where it begins a phrase."""
        entry = self.table[state + letter]
        begins = (entry & ((1 << _CODE_BITS) - 1)) != letter
        return np.where(begins, self.starts[:, letter], entry >> _CODE_BITS), begins

    def _alone(self, language: int, state: int, letters: list[int], kept: list[int]) -> tuple[int, bool, int, int]:
        """One parse, letter by letter, until its state is the kept one: the state, whether that was
        so, the phrases it began and the letters it took."""
        table, starts, begun = memoryview(self.table), memoryview(self.starts[language]), 0
        for n, (letter, other) in enumerate(zip(letters, kept, strict=True), 1):
            entry = table[state + letter]
            if entry & ((1 << _CODE_BITS) - 1) != letter:
                begun += 1
                state = starts[letter]
            else:
                state = entry >> _CODE_BITS
            if state == other:
                return state, True, begun, n
        return state, False, begun, len(letters)

    def _phrases(self, flat: np.ndarray, begin: np.ndarray, size: np.ndarray, follows: np.ndarray) -> np.ndarray:
        """(languages x stretches) phrases that begin in each stretch, when whole texts are parsed.

        All stretches are parsed at once as if each began a text, keeping the state at every
        letter. Where one follows another, the parse that comes in from there is stepped through it
        until it meets the kept one in the same state: from then on they are the same parse. One that
        doesn't meet it replaces the stretch's own and may change what the next one gets, which is
        stepped again. So every text is parsed exactly as from its first letter on.
        """
        k, n, longest = len(self.languages), len(size), int(size.max(initial=0))
        # In order of their lengths, so that the stretches still running at a step are the first ones.
        order = np.argsort(-size, kind="stable")
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        before = place[np.maximum(order - 1, 0)]  # the stretch in front of each
        behind = place[np.minimum(order + 1, n - 1)]
        size, begin, after_one = size[order], begin[order], follows[order]
        leads = np.append(follows[1:], False)[order] if n else follows
        running = np.searchsorted(-size, -np.arange(longest), side="left")
        states, counts = np.zeros((longest, k, n), np.int32), np.zeros((longest + 1, k, n), np.int16)
        final = np.repeat(np.array(self.roots, np.int64)[:, None], n, axis=1)
        count = np.zeros((k, n), np.int16)
        for t, m in enumerate(running.tolist()):
            final[:, :m], begins = self._step(final[:, :m], flat[begin[:m] + t])
            states[t, :, :m] = final[:, :m]
            count[:, :m] += begins
            counts[t + 1] = count
        total = count.astype(np.int64)
        todo = np.flatnonzero(after_one)
        while len(todo):  # rising, so longest first
            now = final[:, before[todo]]
            found, met = np.zeros((k, len(todo)), np.int64), np.zeros((k, len(todo)), bool)
            live = np.arange(len(todo))
            for t in range(int(size[todo[0]])):
                # Those that go on and haven't met the kept parse in every language.
                live = live[(size[todo[live]] > t) & ~met[:, live].all(axis=0)]
                if len(live) <= FEW:
                    for j in live.tolist():
                        for i in np.flatnonzero(~met[:, j]).tolist():
                            lane = int(todo[j])
                            letters = flat[begin[lane] + t:begin[lane] + size[lane]].tolist()
                            kept = states[t:size[lane], i, lane].tolist()
                            now[i, j], met[i, j], more, steps = self._alone(i, int(now[i, j]), letters, kept)
                            found[i, j] += more + (int(count[i, lane]) - int(counts[t + steps, i, lane]) if met[i, j] else 0)
                    break
                at = todo[live]
                held, open_ = now[:, live], ~met[:, live]
                stepped, begins = self._step(held, flat[begin[at] + t])
                same = open_ & (stepped == states[t][:, at])
                # What the kept parse counts behind this letter follows.
                found[:, live] += (open_ & begins) + np.where(same, count[:, at] - counts[t + 1][:, at], 0)
                now[:, live] = np.where(open_, stepped, held)
                met[:, live] |= same
            total[:, todo] = found
            last = np.where(met, states[size[todo] - 1, :, todo].T, now)
            changed = (last != final[:, todo]).any(axis=0)
            final[:, todo] = last
            # A changed end matters to the stretch behind it.
            todo = todo[changed]
            todo = np.sort(behind[todo[leads[todo]]])
        return total[:, place]

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        if not self.languages or not texts:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        bits, real = self.entropies(texts)
        best = bits.argmin(axis=0)
        ranked = np.sort(bits, axis=0)
        sure = 1 - ranked[0] / np.maximum(ranked[1], 1e-12) if len(ranked) > 1 else np.ones(len(texts))
        return ([self.languages[b] if r else UNKNOWN for b, r in zip(best.tolist(), real.tolist(), strict=True)],
                np.where(real, np.clip(sure, 0, 1), 0.0).tolist())


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           documents: int = SAMPLE_DOCUMENTS, chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Labelled text of each language, of rows that are not held out: a bounded, hash-ordered sample.

    A sampled text gives at most 20 times its share of the characters; a longer one, stretches from all over it.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[lang_col].alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    by_hash = Window.partitionBy("lang").orderBy("hash", "id", "text")
    # A hash share of each language's rows that holds the sample a few times over; its first by hash are the sample.
    # One row per language reaches the driver here.
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return {}
    shares = F.create_map(*[x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(int(min(1.0, 4 * documents / n) * (1 << 30))))])
    most = max(1, min(chars, 20 * chars // documents))
    piece = max(1, (most - PIECES + 1) // PIECES)
    stretch = lambda i: F.substr("text", (F.floor((F.length("text") - piece) * i / (PIECES - 1)) + 1).cast("int"), F.lit(piece))
    share = F.when(F.length("text") <= most, F.col("text")).otherwise(F.concat_ws("\n", *map(stretch, range(PIECES))))
    few = rows.withColumn("hash", F.xxhash64("id", "text")).where(F.pmod("hash", F.lit(1 << 30)) < shares[F.col("lang")]).select(
        "lang", "id", "hash", share.alias("text")).withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= documents)
    out: dict[str, list[str]] = {}
    for lang, text, _ in sorted({(r["lang"], r["text"], r["n"]) for r in few.select("lang", "text", "n").collect()},
                                key=lambda r: (r[0], r[2])):
        held = out.setdefault(lang, [])
        if text not in held and sum(map(len, held)) < chars:
            held.append(text)
    return {k: "\n".join(v)[:chars] for k, v in out.items()}


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **limits) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    return predictions(docs, sample(docs, id_col, text_col, lang_col, **limits), id_col, text_col)


def _predictor(samples: dict[str, str]):
    name = "language " + hashlib.sha256(repr(sorted(samples.items())).encode()).hexdigest()
    return lambda: resident(name, lambda: Model(samples))


def predictions(docs: DataFrame, samples: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    model = _predictor(samples)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", max_bytes=SLICE_BYTES):
            langs, scores = model().predict(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    rows = id_and_text(docs, id_col, text_col).withColumn("held_out", held_out(F.col("doc_id")))
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")


def with_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **limits) -> DataFrame:
    """``docs`` without the rows that are ``und``, with the predicted language in ``lang_col``."""
    model = _predictor(sample(docs, id_col, text_col, lang_col, **limits))
    names = docs.columns

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col, max_bytes=SLICE_BYTES):
            langs, _ = model().predict([t or "" for t in part.column(text_col).to_pylist()])
            part = part.set_column(names.index(lang_col), lang_col, pa.array(langs, pa.string()))
            yield part.filter(pa.compute.not_equal(part.column(names.index(lang_col)), UNKNOWN))

    return docs.mapInArrow(label, docs.schema)
