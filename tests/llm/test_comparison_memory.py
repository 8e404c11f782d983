"""Memory of one comparison of two blocks of sets."""

import tracemalloc

import numpy as np
import pyarrow as pa

from beatline.llm import chosen_path


def _near_copies(n):
    rng = np.random.default_rng(1)
    base = np.sort(rng.integers(0, 2**63, 300).astype(np.uint64))
    kept = [base[np.sort(rng.permutation(300)[:290])] for _ in range(n)]
    return [np.sort(np.concatenate([x, rng.integers(0, 2**63, 10).astype(np.uint64)])) for x in kept]


def _batch(sets, **columns):
    n = len(sets)
    bucket = {"leaf": [5] * n, "low": [0] * n, "high": [1] * n, "side": [i % 2 for i in range(n)], "leaves": [[5]] * n}
    return pa.RecordBatch.from_pydict({**bucket, "digest": [i.to_bytes(16, "big") for i in range(n)], **columns})


def _with_peak(function, batch):
    tracemalloc.start()
    rows = pa.Table.from_batches(list(function(0.8, iter([batch])))).to_pylist()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return rows, peak


def test_two_full_blocks_need_little_memory():
    n = 2 * chosen_path.BLOCK_SETS
    sets = _near_copies(n)
    sketches = [(x >> np.uint64(32)).astype("<u4")[: chosen_path.SKETCH].tobytes() for x in sets]
    rows, peak = _with_peak(chosen_path._plausible, _batch(sets, size=[len(x) for x in sets], sketch=sketches))
    assert len(rows) == n and peak < 75
    rows, peak = _with_peak(chosen_path._links, _batch(sets, copies=[2] * n, members=[x.astype("<u8").tobytes() for x in sets]))
    assert [r["set_links"] for r in rows] == [n // 2] * n and [r["links"] for r in rows] == [n] * n
    assert {r["root"] for r in rows} == {bytes(16)} and peak < 75


def test_common_members_in_parts(monkeypatch):
    sets = [*_near_copies(12), np.zeros(0, dtype=np.uint64)]
    expected = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    off_diagonal = ~np.eye(len(sets), dtype=bool)
    for members in (1 << 18, 700, 1):
        monkeypatch.setattr(chosen_path, "MEMBERS_AT_ONCE", members)
        assert (chosen_path.common(sets) == expected)[off_diagonal].all()
    signed = [x.astype(np.int64) - 2**62 for x in sets]
    monkeypatch.setattr(chosen_path, "MEMBERS_AT_ONCE", 700)
    assert (chosen_path.common(signed) == expected)[off_diagonal].all()
