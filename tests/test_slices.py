import random

import pyarrow as pa

from veridact.operators import quotes
from veridact.sources import json_arrays as J


def test_workers_hold_few_texts_at_a_time():
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000))], ["n"])
    parts = list(quotes._slices(iter([batch])))
    assert max(p.num_rows for p in parts) <= quotes.SLICE and pa.Table.from_batches(parts).column("n").to_pylist() == list(range(1000))


def slow_tally(values):
    t = [0, 0, 0]
    for v in values:
        for m in J._MARK.finditer(v + "}"):
            c = m.group()
            if c == '"':
                t[0] += 1
            elif c in "{[":
                t[1 + t[0] % 2] += 1
            elif c in "}]":
                t[1 + t[0] % 2] -= 1
    return t


def test_tallies_and_whole_elements_equal_the_walk_by_marks(monkeypatch):
    rng = random.Random(3)
    batch = lambda cols: pa.RecordBatch.from_arrays([pa.array(c) for c in cols], [str(i) for i in range(len(cols))])
    walked, quick = 0, 0
    for _ in range(3000):
        values = ["".join(rng.choice(['"', "{", "[", "]", "\\", "a", ",", "\\\"", '"x"', '{"a": 1', '"k": ["b"]']) for _ in range(rng.randint(0, 9))) for _ in range(4)]
        n = len(values)
        (got,) = [[b.column(i)[0].as_py() for i in (2, 3, 4)] for b in J._tally(iter([batch([values, ["f"] * n, [0] * n])]))]
        assert got == slow_tally(values)
        cols = [values, ["f"] * n, [0] * n, [False] * n, [1] * n]
        fast = [b.to_pylist() for b in J._walk(iter([batch(cols)]))]
        with monkeypatch.context() as m:
            m.setattr(J, "_PLAIN", J.re.compile(r"(?!)"))
            assert fast == [b.to_pylist() for b in J._walk(iter([batch(cols)]))]
        walked += 1
        quick += any(J._PLAIN.fullmatch(v + "}") for v in values)
    assert walked == 3000 and quick > 10
