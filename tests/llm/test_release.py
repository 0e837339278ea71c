"""A worker's task gives back what it no longer uses."""

import pyarrow as pa

from ragset.llm.common import tidy


def test_tidy_keeps_every_batch_and_releases_at_the_end(monkeypatch):
    released, seen = [], []

    class Pool:
        def release_unused(self):
            released.append(len(seen))

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    for x in tidy(lambda batches: (b + 1 for b in batches))(iter([1, 2, 3])):
        assert not released
        seen.append(x)
    assert seen == [2, 3, 4] and released == [3]
    assert list(tidy(lambda batches: batches)(iter([]))) == [] and len(released) == 2
