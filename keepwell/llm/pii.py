"""Personal data: rules, and a semi-Markov conditional random field on top of them.

The rules find e-mail addresses, IP addresses, card and phone numbers by form. The
model looks at the parts of a text that hold a digit, an at sign or a value after a cue word,
cut into units (runs of letters and digits, and single symbols). It scores every candidate
segment of up to ``MOST_UNITS`` units of any length, and whole values of more units, by features of the whole span (shape, counts
of digits and letters, checksum, octets, neighbours, the word before) and picks
boundaries and types together by dynamic programming over segments. It is fitted
by maximum likelihood on parts labelled by the rules, by cue words for secrets, and
on copies in which telling marks such as a leading plus are taken away, so that
it also finds what the rules miss. Spans found by rules stay; a span of the model
is added where it meets none of them.

Every text is searched whole; a null counts as empty. An empty table is searched by the
model without weights, which finds nothing. Equal scores prefer no entity, then the
shorter one, then the kind listed first. Repeated rows get equal results. ``find`` reads
only key and text; ``mask`` returns all columns.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keepwell.session import ship_package

RULES = ("email", "ip", "card", "phone")
KINDS = (*RULES, "secret")
MOST_UNITS = 16
#: labelled parts the model is fitted on at most, and texts (about) that they are taken from
SAMPLE = 3000
SAMPLE_TEXTS = 60_000
#: how much better than no entity a segment must be
MARGIN = 2.0

# The lookbehind and the possessive runs change no match; they keep long runs of digits linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_CUE = re.compile(r"(?:password|passwd|pwd|token|secret|api[_-]?key)[\x20\t]{0,2}[=:][\x20\t]{0,2}[\"']?([A-Za-z0-9_/+-]{8,})", re.I)
_KEY_ID = re.compile(r"(?<![A-Za-z0-9])[A-Z]{4}[A-Z0-9]{16}(?![A-Za-z0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the address pattern, found from the at signs outward."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        else:
            end = max(end, at + 1)  # nothing before this sign can be part of a later match
        at = text.find("@", max(at + 1, end))


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end), ordered."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in emails(text)]
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if 14 <= m.end() - m.start() and 14 <= len(d := "".join(_DIGITS.findall(m[0]))) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


_TRIGGER = re.compile(r"[0-9@]\S*")
#: values of more units than a segment has are candidates as a whole
_VALUE = re.compile(r"[A-Za-z0-9_/+-]{8,}")
_UNIT = re.compile(r"[A-Za-z0-9]+|[^\sA-Za-z0-9]")
_WORD = re.compile(r"([A-Za-z]+)[^A-Za-z0-9]{0,6}$")


def _triggers(text: str) -> Iterator[tuple[int, int]]:
    """Spans that make a part, by start: from a digit or an at sign, or from a cue word, to the end of the token."""
    marks, cues = _TRIGGER.finditer(text), _CUE.finditer(text)
    mark, cue = next(marks, None), next(cues, None)
    end = 0
    while mark or cue:
        if cue and (not mark or cue.start() <= mark.start()):
            end = max(end, cue.end())  # a token of many cues is walked through once
            while end < len(text) and not text[end].isspace():
                end += 1
            yield cue.start(), end
            cue = next(cues, None)
        else:
            yield mark.span()
            mark = next(marks, None)


def parts(text: str) -> Iterator[tuple[int, int]]:
    """Runs of blank-separated tokens that hold a digit or an at sign, or a value after a cue word."""
    begin = end = -1
    for start, stop in _triggers(text):
        if stop <= end:
            continue
        while start > max(end, 0) and not text[start - 1].isspace():
            start -= 1
        if begin >= 0 and (start < end or start - end <= 2 and not text[end:start].strip(" \t")):
            end = stop
            continue
        if begin >= 0:
            yield begin, end
        begin, end = start, stop
    if begin >= 0:
        yield begin, end


def _bucket(n: int) -> int:
    return n if n <= 4 else int(4 + 2 * math.log2(n / 4))


_SHAPE = str.maketrans({**{c: "9" for c in "0123456789"}, **{c: "a" for c in "bcdefghijklmnopqrstuvwxyz"}, **{c: "A" for c in "BCDEFGHIJKLMNOPQRSTUVWXYZ"}, "\t": " "})
_RUNS = re.compile(r"(.)\1+")


def features(text: str, start: int, end: int, word: str) -> list[str]:
    """Names of the whole-span features of a segment."""
    span = text[start:end]
    exact = span.translate(_SHAPE)
    shape = _RUNS.sub(r"\1", exact)
    digits = exact.count("9")
    letters = exact.count("a") + exact.count("A")
    before = text[start - 1 : start].translate(_SHAPE) or "^"
    after = text[end : end + 1].translate(_SHAPE) or "$"
    out = [
        "any",
        f"shape={shape[:16]}",
        f"digits={_bucket(digits)}",
        f"letters={_bucket(letters)}",
        f"symbols={_bucket(len(span) - digits - letters)}",
        f"before={before}",
        f"after={after}",
        f"ends={exact[0]}{exact[-1]}",
    ]
    if word:
        out.append(f"word={word}")
    if "@" in span:
        out.append(f"at={span.count('@')},{'.' in span.rpartition('@')[2]}")
    elif not letters:
        if digits >= 10:
            out.append(f"number={min(digits, 20)},{span[0] == '+'},{digits == len(span)}")
        if digits >= 13:
            out.append(f"luhn={luhn(''.join(_DIGITS.findall(span)))}")
        if exact.count(".") == 3 and shape == "9.9.9.9":
            out.append(f"octets={all(len(x) < 4 and int(x) < 256 for x in span.split('.'))}")
    elif digits and letters + digits == len(span):
        out.append(f"code={_bucket(len(span))},{span.isupper()},{span.islower()}")
    return out


def possible(span: str) -> list[bool]:
    """Which kinds a segment can be at all: cards pass the checksum, addresses have four octets."""
    digits = "".join(_DIGITS.findall(span))
    plain = not any(c.isalpha() or c == "@" for c in span)
    octets = span.split(".")
    return [
        span.count("@") == 1 and "." in span.rpartition("@")[2],
        len(octets) == 4 and all(x.isdigit() and len(x) <= 3 and int(x) <= 255 for x in octets),
        plain and 14 <= len(digits) <= 19 and luhn(digits),
        plain and 10 <= len(digits) <= 15 and "." not in span[:2],
        "@" not in span and len(span) >= 8,
    ]


def segments(text: str, begin: int, end: int) -> tuple[list[tuple[int, int]], list[tuple[int, int, list[str]]]]:
    """(units, candidates as (first unit, unit after the last, features)) of a part."""
    units = [m.span() for m in _UNIT.finditer(text, begin, end)]
    values = [m.span(1) for m in _CUE.finditer(text, begin, end)]
    hot = [any(c in "0123456789@" for c in text[s:e]) for s, e in units]
    starts, ends = {s: i for i, (s, _) in enumerate(units)}, {e: i + 1 for i, (_, e) in enumerate(units)}
    for s, e in values:
        if s in starts and e in ends:
            hot[starts[s] : ends[e]] = [True] * (ends[e] - starts[s])
    long = set()
    if len(units) > MOST_UNITS:
        whole = [m.span() for m in _VALUE.finditer(text, begin, end)] + values
        whole += [(begin + s, begin + e) for s, _, e in rule_spans(text[begin:end])]
        pairs = {(starts[s], ends[e]) for s, e in whole if s in starts and e in ends}
        long = {(i, j) for i, j in pairs if j - i > MOST_UNITS and any(hot[i:j])}
    words = [(m := _WORD.search(text[max(0, s - 24) : s])) and m[1].lower() or "" for s, _ in units]
    out = []
    for i, (s, _) in enumerate(units):
        seen = False
        for j in range(i, min(i + MOST_UNITS, len(units))):
            seen |= hot[j]
            if seen:
                out.append((i, j + 1, features(text, s, units[j][1], words[i])))
    out += [(i, j, features(text, units[i][0], units[j - 1][1], words[i])) for i, j in sorted(long)]
    return units, out


def best(
    text: str, units, found, weights: dict[str, np.ndarray], margin: float = MARGIN
) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the best-scoring segmentation into possible segments."""
    n = len(units)
    ending: list[list[tuple[int, float, int]]] = [[] for _ in range(n + 1)]
    for i, j, names in found:
        score = sum((weights[f] for f in names if f in weights), np.zeros(len(KINDS)))
        if score.max() > margin:
            score = np.where(possible(text[units[i][0] : units[j - 1][1]]), score, -np.inf)
            k = int(score.argmax())
            if score[k] > margin:
                ending[j].append((i, float(score[k]) - margin, k))
    value, back = [0.0] * (n + 1), [None] * (n + 1)
    for j in range(1, n + 1):
        value[j] = value[j - 1]
        for i, score, k in sorted(ending[j], reverse=True):
            if value[i] + score > value[j]:
                value[j], back[j] = value[i] + score, (i, k)
    out, j = [], n
    while j:
        if back[j]:
            i, k = back[j]
            out.append((units[i][0], k, units[j - 1][1]))
            j = i
        else:
            j -= 1
    return out[::-1]


def labelled(text: str) -> list[tuple[int, int, int]]:
    """Spans for fitting: the rules', and values that follow a cue word or look like key ids."""
    secrets = [(m.start(1), 4, m.end(1)) for m in _CUE.finditer(text)]
    secrets += [(m.start(), 4, m.end()) for m in _KEY_ID.finditer(text) if _DIGITS.search(m[0])]
    out, end = [], 0
    for s, k, e in sorted(rule_spans(text) + secrets):
        if s >= end:
            out.append((s, k, e))
            end = e
    return out


def examples(text: str) -> Iterator[tuple[str, int, int, list[tuple[int, int, int]]]]:
    """The parts of a text with their spans, and variants without the marks the rules need."""
    spans = labelled(text)
    for begin, end in parts(text):
        left, right = max(0, begin - 24), min(len(text), end + 2)
        cut, a, b = text[left:right], begin - left, end - left
        mine = [(s - left, k, e - left) for s, k, e in spans if begin <= s and e <= end]
        yield cut, a, b, mine
        if mine and cut[mine[0][0]] == "+":  # the same phone number without its plus
            s = mine[0][0]
            yield cut[:s] + cut[s + 1 :], a, b - 1, [(x - (x > s), k, e - 1) for x, k, e in mine]


def fit(samples, rounds: int = 40, rate: float = 0.3, decay: float = 1e-3) -> dict[str, np.ndarray]:
    """Weights of the features for each kind, by gradient steps on the likelihood of the segmentations."""
    names: Counter[str] = Counter()
    cases = []
    for text, begin, end, spans in samples:
        units, found = segments(text, begin, end)
        starts, ends = {s: i for i, (s, _) in enumerate(units)}, {e: i + 1 for i, (_, e) in enumerate(units)}
        gold = {(starts[s], ends[e]): k for s, k, e in spans if s in starts and e in ends}
        # a rule's span that begins or ends within a unit, or reaches over the part, has no segment
        if found and len(gold) == len(spans):
            lost = gold.keys() - {(i, j) for i, j, _ in found}
            assert not any(gold[pair] == KINDS.index("secret") for pair in lost), (text, lost)
            if lost:
                continue  # never taught as holding nothing
            cases.append((len(units), found, gold))
            names.update(f for _, _, x in found for f in x)
    number = {f: i + 1 for i, f in enumerate(sorted(f for f, n in names.items() if n >= 3))}
    if not cases:
        return {}
    width = max(len(x) for _, found, _ in cases for _, _, x in found)
    table, truth, chain = [], [], []
    for n, found, gold in cases:
        chain.append((n, len(table), [(i, j) for i, j, _ in found]))
        for i, j, x in found:
            row = [number.get(f, 0) for f in x]
            table.append(row + [0] * (width - len(row)))
            truth.append(gold.get((i, j), -1))
    table, truth = np.array(table), np.array(truth)
    wanted = np.zeros((len(table), len(KINDS)))
    wanted[np.flatnonzero(truth >= 0), truth[truth >= 0]] = 1
    weights = np.zeros((len(number) + 1, len(KINDS)))
    speed = np.zeros_like(weights)
    for _ in range(rounds):
        score = weights[table].sum(axis=1)
        top = np.logaddexp.reduce(score, axis=1)
        mass = np.zeros(len(table))
        for n, base, found in chain:
            ahead, behind = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]
            by_end: list[list[int]] = [[] for _ in range(n + 1)]
            by_start: list[list[int]] = [[] for _ in range(n + 1)]
            for r, (i, j) in enumerate(found):
                by_end[j].append(r)
                by_start[i].append(r)
            s = top[base : base + len(found)].tolist()
            for j in range(1, n + 1):
                terms = [ahead[j - 1], *(ahead[found[r][0]] + s[r] for r in by_end[j])]
                most = max(terms)
                ahead[j] = most + math.log(sum(math.exp(x - most) for x in terms))
            for i in range(n - 1, -1, -1):
                terms = [behind[i + 1], *(behind[found[r][1]] + s[r] for r in by_start[i])]
                most = max(terms)
                behind[i] = most + math.log(sum(math.exp(x - most) for x in terms))
            for r, (i, j) in enumerate(found):
                mass[base + r] = math.exp(min(0.0, ahead[i] + s[r] + behind[j] - ahead[n]))
        off = wanted - np.exp(score - top[:, None]) * mass[:, None]
        gradient = np.zeros_like(weights)
        for c in range(width):
            np.add.at(gradient, table[:, c], off)
        gradient = gradient - decay * len(cases) * weights
        gradient[0] = 0
        speed += gradient**2
        weights += rate * gradient / np.sqrt(speed + 1e-8)
    return {f: weights[i] for f, i in number.items()}


def train(
    docs: DataFrame, text: str = "text", sample: int = SAMPLE, texts: int = SAMPLE_TEXTS
) -> dict[str, np.ndarray]:
    """Weights from ``sample`` parts at most, half of them with a span: those of least hash in the
    texts of least hash, about ``texts`` of them."""
    ship_package(docs.sparkSession)
    share = int(min(1.0, texts / max(1, docs.count())) * (1 << 30))
    docs = docs.where(F.pmod(F.xxhash64(F.col(text)), F.lit(1 << 30)) < share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(0).to_pylist():
                if value:
                    for cut, a, b, spans in examples(value):
                        if b - a <= 400:
                            rows.append((cut, a, b, [list(s) for s in spans], bool(spans)))
            if rows:
                cols = list(zip(*rows))
                kinds = (pa.string(), pa.int32(), pa.int32(), pa.list_(pa.list_(pa.int32())), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, kinds)], ["cut", "a", "b", "spans", "some"]
                )

    schema = "cut string, a int, b int, spans array<array<int>>, some boolean"
    found = docs.select(F.col(text).alias("text")).mapInArrow(run, schema)
    # a part met again adds nothing; its spans are fixed by its text
    found = found.dropDuplicates(["cut", "a", "b"])
    order = F.xxhash64("cut", "a", "b")
    found = found.withColumn("o", order).withColumn("half", F.pmod(F.shiftright("o", 40), F.lit(2)))
    rows = []
    for some in (True, False):
        rows += found.where(F.col("some") == some).orderBy("o", "cut").limit(sample // 2).collect()
    unique = {(r.cut, r.a, r.b): [tuple(s) for s in r.spans] for r in rows}
    return fit([(*k, v) for k, v in sorted(unique.items())])


def model_spans(text: str, rules, weights) -> list[tuple[int, int, int]]:
    """Spans of the model that meet none of the rules'."""
    out = []
    if weights:
        for begin, end in parts(text):
            for s, k, e in best(text, *segments(text, begin, end), weights):
                if not any(s < y and x < e for x, _, y in rules):
                    out.append((s, k, e))
    return out


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", weights=None) -> DataFrame:
    """Per text: counts of the rules' kinds, digest of the rules' spans, all spans, number added."""
    weights = train(docs, text) if weights is None else weights
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    names = [key, *(f"n_{k}" for k in RULES), "base_sha256", "spans", "n_added"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1).to_pylist():
                rules = rule_spans(value or "")
                more = model_spans(value or "", rules, shared.value)
                count = Counter(k for _, k, _ in rules)
                digest = hashlib.sha256(joined(rules).encode()).hexdigest()
                rows.append((*(count[k] for k in range(len(RULES))), digest, joined(sorted(rules + more)), len(more)))
            cols = list(zip(*rows)) or [()] * (len(names) - 1)
            kinds = [pa.int64()] * len(RULES) + [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds))], names)

    kind = docs.schema[key].dataType.simpleString()
    counts = ", ".join(f"{n} long" for n in names[1:5])
    return docs.select(F.col(key), F.col(text).alias("__text")).mapInArrow(
        run, f"`{key}` {kind}, {counts}, base_sha256 string, spans string, n_added long"
    )


def masked(text: str, spans) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind's name."""
    out, end = [], 0
    for s, k, e in sorted(spans):
        if s >= end:
            out.append(text[end:s])
            out.append(f"<{KINDS[k].upper()}>")
        end = max(end, e)
    return "".join(out) + text[end:]


def mask(docs: DataFrame, text: str = "text", weights=None) -> DataFrame:
    """``docs`` with all spans masked; nulls stay null. Applied until the rules find nothing more."""
    weights = train(docs, text) if weights is None else weights
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    place = docs.columns.index(text)

    def clean(value: str | None) -> str | None:
        while value and (rules := rule_spans(value)):
            value = masked(value, rules + model_spans(value, rules, shared.value))
        return value and masked(value, model_spans(value, [], shared.value))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = pa.array([clean(x) for x in batch.column(place).to_pylist()], batch.column(place).type)
            yield batch.set_column(place, batch.schema.field(place), new)

    return docs.mapInArrow(run, docs.schema)
