import itertools
import random
import re

import numpy as np
import pytest

from keepwell.llm import pii as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def checksum(number):
    total = 0
    for i, d in enumerate(map(int, reversed(number))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def brute(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [
        (m.start(), 2, m.end())
        for m in CARD.finditer(text)
        if 14 <= len(digits(m[0])) <= 19 and checksum(digits(m[0]))
    ]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


def test_rules_equal_the_patterns(texts):
    rng = random.Random(5)
    odd = ["".join(rng.choice("12345.@a-+ (%9_é") for _ in range(rng.randrange(40))) for _ in range(20000)]
    cards = ["4111 1111 1111 1111", "x4111-1111-1111-1111y", "+4111 1111 1111 11", "0" * 14, "0 " * 14, "1" * 25]
    for text in [*odd, *cards, *(t or "" for t in texts.values())]:
        assert P.rule_spans(text) == brute(text), text


def test_rules_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1 " * 100_000, "@" * 300_000, "a@" * 150_000):
        P.rule_spans(text)
        list(P.parts(text))


@pytest.fixture(scope="module")
def weights():
    rng = random.Random(3)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    lines = []
    for _ in range(150):
        lines.append(f"call me at +1 ({number(3)}) 555-{number(4)} today")
        lines.append(f"mail bob.{number(2)}@mail{number(1)}.example.com please")
        lines.append(f"host 10.{rng.randrange(256)}.{rng.randrange(256)}.7 is up")
        lines.append(f"password={number(6)}ab{number(4)} and so on")
        lines.append(f"version {number(1)}.{number(1)} of {number(4)}, costs {number(3)}.50")
    return P.fit([e for line in lines for e in P.examples(line)])


def test_best_segmentation_equals_enumeration(weights):
    for text in ("x +1 (348) 555-9642 y", "bob.42@mail8.example.com", "10.2.3.4 5", "a 1 2 b"):
        for begin, end in P.parts(text):
            units, found = P.segments(text, begin, end)
            top = {}
            for i, j, names in found:
                score = sum((weights[f] for f in names if f in weights), np.zeros(len(P.KINDS))) - P.MARGIN
                score = np.where(P.possible(text[units[i][0] : units[j - 1][1]]), score, -np.inf)
                top[i, j] = (float(score.max()), int(score.argmax()))
            most = 0.0
            for n in range(len(units) + 1):
                for cuts in itertools.combinations(range(len(units) + 1), n):
                    # every pair of neighbouring cuts may be a segment or not
                    value = sum(max(0.0, top.get(pair, (0.0, 0))[0]) for pair in itertools.pairwise(cuts))
                    most = max(most, value)
            got = P.best(text, units, found, weights)
            starts, ends = {s: i for i, (s, _) in enumerate(units)}, {e: i + 1 for i, (_, e) in enumerate(units)}
            value = sum(top[starts[s], ends[e]][0] for s, _, e in got)
            assert value == pytest.approx(most)


def test_the_model_finds_what_the_rules_miss(weights):
    text = "call 1 (348) 555-9642 or password=771199cd0011 now, version 2.0 of 1999"
    assert P.rule_spans(text) == []
    found = {(P.KINDS[k], text[s:e]) for s, k, e in P.model_spans(text, [], weights)}
    assert found == {("phone", "1 (348) 555-9642"), ("secret", "771199cd0011")}
    rules = P.rule_spans("+1 (348) 555-9642")
    assert P.model_spans("+1 (348) 555-9642", rules, weights) == []  # rules' spans stay as they are


def test_impossible_segments_are_not_found(weights):
    for text in ("no 4111 1111 1111 1112 x", "host 10.2.3.400 is up", "x 12 y", "user@localhost z", "at 2024-01-15 10:30"):
        assert P.rule_spans(text) == P.model_spans(text, [], weights) == []


def test_find_and_mask(spark, documents, texts, weights):
    rows = P.find(documents, weights=weights).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in want) for n in range(4)]
        spans = r.spans.split(",") if r.spans else []
        assert set(P.joined(want).split(",")) - {""} <= set(spans) and len(spans) == len(want) + r.n_added
    masked = P.mask(documents, weights=weights)
    assert masked.schema == documents.schema
    for r in masked.collect():
        assert not brute(r.text or "")
        if not brute(texts[r.doc_id] or "") and not P.model_spans(texts[r.doc_id] or "", [], weights):
            assert r.text == texts[r.doc_id]


def test_training_uses_all_tables_rows_up_to_its_bound(documents):
    found = P.train(documents)
    assert any(f.startswith("shape=") for f in found)
    assert P.train(documents, sample=0) == {}


def test_odd_texts(odd_docs, empty_docs, weights):
    rows = {r.doc_id: r for r in P.find(odd_docs, weights=weights).collect()}
    assert rows[0].spans == "" and rows[0].n_email == 0  # null counts as empty
    assert [rows[8].n_email, rows[8].n_ip, rows[8].n_card, rows[8].n_phone] == [1, 1, 1, 1]
    assert P.find(empty_docs).count() == 0 == P.mask(empty_docs).count()
    kept = {r.doc_id: r.text for r in P.mask(odd_docs, weights=weights).collect()}
    assert kept[0] is None and kept[1] == ""
    assert kept[8] == "mail <EMAIL> or <PHONE>, ip <IP>, card <CARD>."


def test_overlapping_spans_are_masked_together():
    assert P.masked("abcdefgh", [(1, 3, 4), (2, 2, 6)]) == "a<PHONE>gh"


def test_secrets_of_any_length_and_without_digits_are_found():
    rng = random.Random(9)
    make = lambda n, among: "".join(rng.choice(among) for _ in range(n))
    lines = []
    for _ in range(120):
        lines.append(f"password={make(rng.randint(8, 14), 'abcdefghijklmnop')} and so on")
        lines.append(f"token={make(128, '0123456789abcdef')} and so on")
        lines.append("secret: " + "-".join(make(3, "0123456789abc") for _ in range(14)) + " for you")
        lines.append(f"version {make(1, '123')}.{make(1, '123')} of {make(4, '123')}, costs {make(3, '123')}.50")
    weights = P.fit([e for line in lines for e in P.examples(line)])
    for secret in ("correcthorse", make(128, "0123456789abcdef"), "-".join(make(3, "0123456789abc") for _ in range(14))):
        for cue in ("password=", "token="):
            text = f"the {cue}{secret} is mine"
            assert [(P.KINDS[k], text[s:e]) for s, k, e in P.model_spans(text, [], weights)] == [("secret", secret)]
    assert P.model_spans("the password is correct, version 2.0 of 1999", [], weights) == []


def test_every_labelled_secret_is_a_candidate():
    for text in ("api_key = abcdefgh", "pwd='" + "a-" * 40 + "1'", "token: " + "F" * 300, "secret=" + "ab/" * 30):
        ((_, k, e),) = P.labelled(text)
        (s, _, _) = P.labelled(text)[0]
        ((begin, end),) = P.parts(text)
        units, found = P.segments(text, begin, end)
        assert (s, e) in {(units[i][0], units[j - 1][1]) for i, j, _ in found} and k == 4
