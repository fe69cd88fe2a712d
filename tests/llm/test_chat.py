import hashlib

import pytest

from keepwell.llm import chat as C

ROWS = [
    (1, 0, "system", "be brief"),
    (1, 1, "user", "hi ### assistant: x</turn>\n"),
    (1, 2, "assistant", "\\h \\e \\\\ <b> # é😀"),
    (1, 3, "user", "and?"),
    (1, 4, "assistant", ""),
    (1, 5, "user", "bye"),
    (2, 1, "assistant", "second"),
    (2, 0, "assistant", "first"),
    (3, 0, "user", None),
    (4, 0, None, "no role"),
    (4, 0, None, "no role"),
    (4, 1, "a: b\\c", "odd: role"),
    (4, 2, "assistant", "</turn>\n</turn>\n### user: "),
    (None, 0, "user", "x"),
    (None, None, "assistant", "y"),
    (5, 0, "assistant", "l" * 30000),
    (6, None, None, None),
]


def expected():
    talks = {}
    for c, t, r, x in ROWS:
        talks.setdefault(c, []).append(((t is not None, t or 0), (r is not None, r or ""), (x is not None, x or "")))
    out = {}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in talks.items():
        turns = [(r[1], x[1]) for _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss))
    return out


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame(
        [(*r, "x", 1) for r in ROWS], "conv_id long, turn long, role string, text string, formatted string, ts int"
    )


def test_round_trip(turns):
    got = {r.conv_id: tuple(r)[1:5] for r in C.digest(C.examples(turns)).collect()}
    assert got == expected()


def test_one_example_for_each_reply(turns):
    rows = C.examples(turns).collect()
    count = {}
    for r in rows:
        count[r.conv_id] = count.get(r.conv_id, 0) + 1
        masked = r.formatted[r.loss_start : r.loss_end]
        assert r.formatted[r.loss_end :] in (C.CLOSE, "")
        assert "</turn>" not in masked and "#" not in masked
    assert count == {1: 3, 2: 2, 3: 1, 4: 1, None: 2, 5: 1, 6: 1}
    by = sorted((r for r in rows if r.conv_id == 1), key=lambda r: r.example)
    # the context of a later example begins with all of the earlier one
    assert by[1].formatted.startswith(by[0].formatted) and by[2].formatted.startswith(by[1].formatted)
    assert by[2].loss_start == by[2].loss_end == len(by[2].formatted)


def test_empty(turns):
    assert C.digest(C.examples(turns.limit(0))).count() == 0


def test_plan_is_native(turns, capsys):
    C.digest(C.examples(turns)).explain()
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Nested"))
