"""What a Python worker keeps between tasks."""

from typeferry.llm import common


def test_arrow_lets_go_at_each_task(monkeypatch):
    class Pool:
        released = 0

        def release_unused(self):
            Pool.released += 1

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    common.begin("one")
    common.begin("one")
    assert Pool.released == 2
