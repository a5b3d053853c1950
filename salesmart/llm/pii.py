"""Personal data by weak supervision (operator 8).

Candidates are the base matches of the contract's four kinds, and looser ones
(phone numbers without a country code, identity numbers, account numbers, names).
Labelers vote on each: 1 (personal), 0 (not) or - (no opinion):

* format:   the strict pattern of the kind holds;
* check:    checksum or number range;
* context:  a cue before the span ("phone", "mail", "card", a title ...);
* counter:  what surrounds the span speaks against it (versions, amounts, units, part of a word);
* gazetteer: first names, mail and country domains, reserved networks.

Candidates are counted by kind, votes and traits (span length, separators, a hash
of the word before, what follows), so what reaches the driver is bounded by the
patterns there are (at most KINDS x 3^5 x 612, thousands in practice), whatever
the corpus. On the votes' counts expectation-maximisation estimates each labeler's
reliability; its posteriors train a logistic span classifier over votes, kinds and
traits, which the labelers don't see. Base spans always stay; other candidates
stay where the classifier says so.

The base patterns run in time linear in the text: a run of digits or of mail
characters is tried from its first one only, from which it matches if it does at all.

Positions are code points. Null and empty texts have no spans; repeated rows
are scanned each; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import id_and_text, slices, written

# The contract's patterns.
_MAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
EMAIL, EMAIL_HERE = re.compile(rf"(?<![A-Za-z0-9._%+-]){_MAIL}"), re.compile(_MAIL)
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "national", "account", "person")
LABELERS = ("format", "check", "context", "counter", "gazetteer")

LOOSE_PHONE = re.compile(r"(?<![\w+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])")
NATIONAL = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
ACCOUNT = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
PERSON = re.compile(r"(?<!\w)(?:(?:Mr|Mrs|Ms|Dr|Prof)\.? )?[A-Z][a-z]+ [A-Z][a-z]+(?!\w)")
# Word lists of the gazetteers.
FIRST_NAMES = frozenset("""James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara
    Richard Susan Joseph Jessica Thomas Sarah Charles Karen Hans Anna Peter Ursula Klaus Sabine Pierre Marie Jean
    Claire Luc Sophie Carlos Maria Jose Carmen Juan Lucia Pedro Isabel""".split())
DOMAINS = frozenset("com org net edu gov io de fr es uk it nl eu info".split())
CUES = {
    "email": r"e-?mail|mail|contact|correo|courriel|write to", "ip": r"\bip\b|address|host|server|login|client",
    "card": r"card|visa|master|amex|credit|karte|carte|tarjeta", "phone": r"phone|tel|call|fax|mobile|cell|telefon|ring",
    "national": r"ssn|social|security|national|identity", "account": r"iban|account|konto|compte|cuenta|bank",
    "person": r"name|mr|mrs|ms|dr|prof|dear|signed|by",
}
_CUES = {k: re.compile(f"(?:{v})[^\n]{{0,12}}$", re.I) for k, v in CUES.items()}
_COUNTER_BEFORE = re.compile(r"(?:version|v\.?|section|page|no\.|isbn|[$€£#=/*])\s?$", re.I)
_COUNTER_AFTER = re.compile(r"^\s?(?:%|€|\$|kg|km|cm|mm|MB|GB|px\b|[*/=])")
_TITLE = re.compile(r"(?:Mr|Mrs|Ms|Dr|Prof)\.? ")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _mod97(text: str) -> bool:
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _byte(digits: str) -> bool:
    """Whether a number, however many zeros lead it, is at most 255."""
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping mail addresses; one may begin in the run in which the last one ended."""
    found = EMAIL.search(text)
    while found:
        yield found.span()
        found = EMAIL_HERE.match(text, found.end()) or EMAIL.search(text, found.end())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start: leftmost non-overlapping matches that pass their check."""
    out = []
    if "@" in text:
        out += [(0, *span) for span in _emails(text)]
    if "." in text:
        out += [(1, *m.span()) for m in IP.finditer(text)
                if all(_byte(p) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def _loose(text: str) -> Iterator[tuple[int, int, int]]:
    for kind, pattern in ((3, LOOSE_PHONE), (4, NATIONAL)):
        for m in pattern.finditer(text):
            yield kind, *m.span()
    for m in ACCOUNT.finditer(text):
        yield 5, *m.span()
    for m in PERSON.finditer(text):
        words = m[0].split()
        if words[0] in FIRST_NAMES or _TITLE.match(m[0]):
            yield 6, *m.span()


def votes(text: str, kind: int, start: int, end: int) -> str:
    """One letter per labeler: 1, 0 or -."""
    span, before, after = text[start:end], text[max(0, start - 40):start], text[end:end + 12]
    name, digits = KINDS[kind], _digits(span)
    format_, check, gazetteer = "1", "-", "-"
    if name == "email":
        gazetteer = "1" if span.rsplit(".", 1)[-1].lower() in DOMAINS else "0"
        format_ = "1" if not span.startswith(".") and ".." not in span else "0"
    elif name == "ip":
        parts = span.split(".")
        check = "1" if all(len(p) <= 3 and _byte(p) for p in parts) else "0"
        gazetteer = "0" if parts[0] in ("0", "127", "255") else "-"
    elif name == "card":
        check = "1" if luhn(digits) else "0"
        gazetteer = "1" if digits[0] in "3456" else "0"
    elif name == "phone":
        check = "1" if 9 <= len(digits) <= 15 else "0"
        format_ = "1" if span.startswith("+") else "0"
    elif name == "national":
        check = "0" if span[:3] in ("000", "666") or span[0] == "9" or span[4:6] == "00" or span[7:] == "0000" else "1"
    elif name == "account":
        check = "1" if _mod97(span) else "0"
    else:
        gazetteer = "1" if FIRST_NAMES & set(span.split()) else "0"
        check = "1" if _TITLE.match(span) else "-"
    context = "1" if _CUES[name].search(before) else "-"
    glued = (before[-1:].isalnum() and text[start:start + 1].isalnum()) or (after[:1].isalnum() and span[-1:].isalnum())
    counter = "0" if glued or _COUNTER_BEFORE.search(before) or _COUNTER_AFTER.search(after) else "1"
    return format_ + check + context + counter + gazetteer


_WORD_BEFORE = re.compile(r"([^\W\d_]+)\W{0,3}$")
WORDS = 16


def traits(text: str, start: int, end: int) -> str:
    """Four letters that the labelers don't look at: length, separators, word before, what follows."""
    span = text[start:end] if end - start <= 64 else text[start:start + 64]
    marks = len({c for c in span if not c.isalnum()})
    word = _WORD_BEFORE.search(text[max(0, start - 24):start])
    after = text[end:end + 1]
    return (f"{min(3, (end - start) // 8)}{min(2, marks)}"
            f"{format(zlib.crc32(word[1].lower().encode()) % WORDS, 'x') if word else '-'}"
            f"{'s' if not after.strip() else 'a' if after.isalnum() else 'p'}")


def estimate(counts: dict[tuple[str, str], int], rounds: int = 200) -> dict[tuple[str, str], float]:
    """Posterior of "personal" per (kind, votes), by expectation-maximisation over vote counts.

    Each labeler has, per truth, probabilities of 1, 0 and - shared by all kinds;
    each kind has its own prior. Starts from the majority vote; add-one smoothed.
    """
    keys = sorted(counts)
    if not keys:
        return {}
    n = np.array([counts[k] for k in keys], float)
    kinds = np.array([KINDS.index(k) for k, _ in keys])
    seen = np.array([["10-".index(c) for c in v] for _, v in keys]).reshape(len(keys), len(LABELERS))
    yes, no = (seen == 0).sum(axis=1), (seen == 1).sum(axis=1)
    p = (yes + 0.5) / (yes + no + 1)
    for _ in range(rounds):
        prior = np.array([(1 + (n * p)[kinds == k].sum()) / (2 + n[kinds == k].sum()) for k in range(len(KINDS))])
        scores = []
        for weight in (p, 1 - p):
            table = np.stack([[1 + (n * weight)[seen[:, j] == v].sum() for v in range(3)] for j in range(len(LABELERS))])
            table /= table.sum(axis=1, keepdims=True)
            scores.append(np.log(table)[np.arange(len(LABELERS))[None, :], seen].sum(axis=1))
        odds = scores[0] - scores[1] + np.log(prior / (1 - prior))[kinds]
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - p).max(initial=0) < 1e-6:
            break
        p = new
    return dict(zip(keys, p.tolist(), strict=True))


_TRAITS = ("0123", "012", "0123456789abcdef-", "sap")


def _features(keys: list[tuple[str, str, str]]) -> np.ndarray:
    rows = [[1.0] + [float(k == x) for x in KINDS] + [float(c == x) for c in v for x in "10"]
            + [float(c == x) for c, letters in zip(t, _TRAITS, strict=True) for x in letters]
            + [float(k == x and t[0] == n) for x in KINDS for n in _TRAITS[0]] for k, v, t in keys]
    return np.array(rows).reshape(len(keys), 1 + len(KINDS) + 2 * len(LABELERS) + sum(map(len, _TRAITS)) + len(KINDS) * len(_TRAITS[0]))


def train(counts: dict[tuple[str, str, str], int], posterior: dict[tuple[str, str], float],
          ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights of the span classifier: ridge logistic regression (Newton steps) of the posteriors of
    the votes on votes, kind and traits, weighted by counts."""
    keys = sorted(counts)
    x, y = _features(keys), np.array([posterior[k[:2]] for k in keys])
    n = np.log1p(np.array([counts[k] for k in keys], float))  # so that one frequent pattern doesn't decide alone
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (p - y)) + ridge * w
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _covered(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans cover, rising and apart."""
    starts: list[int] = []
    ends: list[int] = []
    for s, e in sorted((s, e) for _, s, e in spans):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s), ends.append(e)
    return starts, ends


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and found: array<struct<kind, start, end, votes, traits, base>>, by kind, then start."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                          ("votes", pa.string()), ("traits", pa.string()), ("base", pa.bool_())])
        for part in slices(batches, "text"):
            out = []
            for text in part.column("text").to_pylist():
                base = base_spans(text)
                starts, ends = _covered(base)
                # Of the covered stretches the last one that begins before a candidate's end is the only one to ask.
                extra = [c for c in _loose(text) if not (i := bisect.bisect_left(starts, c[2])) or ends[i - 1] <= c[1]]
                out.append([{"kind": k, "start": s, "end": e, "votes": votes(text, k, s, e), "traits": traits(text, s, e), "base": b}
                            for k, s, e, b in sorted([(*x, True) for x in base] + [(*x, False) for x in extra])])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.list_(kind))], names=["doc_id", "found"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        find, "doc_id long, found array<struct<kind:int,start:long,end:long,votes:string,traits:string,base:boolean>>")


def learn(found: DataFrame) -> tuple[dict, dict, np.ndarray]:
    """Counts, posteriors and classifier weights from all candidates' votes."""
    rows = found.select(F.explode("found").alias("s")).groupBy("s.kind", "s.votes", "s.traits").count().collect()
    counts = {(KINDS[r["kind"]], r["votes"], r["traits"]): r["count"] for r in rows}
    of_votes: dict[tuple[str, str], int] = {}
    for (kind, vote, _), n in counts.items():
        of_votes[kind, vote] = of_votes.get((kind, vote), 0) + n
    posterior = estimate(of_votes)
    return counts, posterior, train(counts, posterior)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    found = written(candidates(docs, id_col, text_col), "pii-candidates")
    counts, _, weights = learn(found)
    keys = sorted(counts)
    good = sorted(f"{KINDS.index(k)}{v}{t}" for (k, v, t), score in
                  zip(keys, _features(keys) @ weights, strict=True) if score > 0)
    kept = F.filter("found", lambda s: s["base"] | F.concat(s["kind"].cast("string"), s["votes"], s["traits"]).isin(good or [""]))
    names = F.array(*[F.lit(k) for k in KINDS])
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"], s["end"])), ",")
    base = F.filter("found", lambda s: s["base"])
    count = lambda k: F.size(F.filter("found", lambda s: s["base"] & (s["kind"] == k))).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(BASE)],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(kept).alias("spans"))

