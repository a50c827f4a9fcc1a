"""Memory that Python workers hold between tasks."""

import pyarrow as pa

from rollcall.llm.words import word_slices


def _resident() -> int:
    with open("/proc/self/statm") as numbers:
        return int(numbers.read().split()[1]) * 4096


def test_a_worker_gives_back_what_earlier_tasks_freed():
    blocks = [b"x" * (100_000 + i) for i in range(1500)]
    last = blocks[-1]
    del blocks
    before = _resident()
    assert len(next(word_slices(pa.array(["a b"])))) == 1
    assert _resident() < before - 50_000_000 and last
