"""Memory of Python workers between and after batches."""

from ledgerlens.llm import stored


def test_memory_goes_back_after_every_batch(monkeypatch):
    seen = []
    monkeypatch.setattr(stored, "give_back", lambda: seen.append("back"))
    for batch in stored.giving_back(iter("ab")):
        seen.append(batch)
    assert seen == ["a", "back", "b", "back", "back"]
    left = stored.giving_back(iter("ab"))
    next(left)
    seen.clear()
    left.close()  # a task that ends early gives back too
    assert seen == ["back"]


def test_give_back_runs_anywhere():
    stored.give_back()
