import re

import pyarrow as pa
import pytest

from feedloom.operators.packed import PackedConfig, _compiled, split_batch, split_packed

CASES = [
    ("A Capital, B Ventures and C Fund", ["A Capital", "B Ventures", "C Fund"]),
    ('["A Capital", "Ann \\"Annie\\" Lee"]', ["A Capital", 'Ann "Annie" Lee']),
    ('"Lee, A."; B Fund, L.P. (lead)', ["Lee, A.", "B Fund, L.P."]),
    ("Led by A Co, with participation from B & C Partners, and others", ["A Co", "B & C Partners"]),
    ("由甲资本领投，乙基金、丙创投跟投", ["甲资本", "乙基金", "丙创投"]),
    ("1) A One 2) B Two", ["A One", "B Two"]),
    ("- A One\n- B Two", ["A One", "B Two"]),
    ("n/a", []),
    ("", []),
    (None, []),
    ("Undisclosed investors", []),
    ("A One;; ;B Two;", ["A One", "B Two"]),
    ("A One (co-lead)/B Two [lead] + C Three - lead", ["A One", "B Two", "C Three"]),
    ("A\xa0 One，B Two等", ["A One", "B Two"]),
    ('Ann "Annie" Lee, Bob 3" Fund', ['Ann "Annie" Lee', 'Bob 3" Fund']),
    ("「Lee, A.」/B Two", ["Lee, A.", "B Two"]),
    ("A One - lead等", ["A One"]),
]


@pytest.mark.parametrize("text,expected", CASES)
def test_cases(text, expected):
    cfg = PackedConfig()
    _, place, values = split_batch(pa.array([text], pa.string()), cfg, _compiled(cfg))
    assert values == expected
    assert place.tolist() == list(range(1, len(expected) + 1))


def test_batch_matches_rows_alone():
    cfg = PackedConfig()
    p = _compiled(cfg)
    rows = [t for t, _ in CASES] * 3
    parent, _, values = split_batch(pa.array(rows, pa.string()), cfg, p)
    alone = [(i, v) for i, t in enumerate(rows) for v in split_batch(pa.array([t], pa.string()), cfg, p)[2]]
    assert list(zip(parent.tolist(), values, strict=True)) == alone


def test_sliced_array():
    cfg = PackedConfig()
    a = pa.array(["x", "A, B", None, "C"], pa.string()).slice(1, 2)
    assert split_batch(a, cfg, _compiled(cfg))[2] == ["A", "B"]


def test_brute_force_on_simple_lists():
    cfg = PackedConfig()
    rows = [";".join(f"Name{i} Fund" for i in range(k)) for k in range(30)]
    _, _, values = split_batch(pa.array(rows, pa.string()), cfg, _compiled(cfg))
    assert values == [x for r in rows for x in re.split(";", r) if x]


def test_frame(spark):
    long = ", ".join(f"N{i} Capital" for i in range(20000))
    df = spark.createDataFrame([(1, "A, B", 5), (2, None, 6), (1, "A, B", 5), (3, long, 7)], "pos long, investors string, k int")
    out = split_packed(df, "pos", "investors", value="investor")
    assert out.columns == ["pos", "item_no", "investor"]
    rows = out.collect()
    assert sum(r.pos == 1 for r in rows) == 4 and sum(r.pos == 3 for r in rows) == 20000
    assert max(r.item_no for r in rows if r.pos == 3) == 20000
    assert split_packed(df.limit(0), "pos", "investors").count() == 0
