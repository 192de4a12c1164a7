"""What a Python worker holds at a time."""

from __future__ import annotations

import tracemalloc

import pandas as pd

from termweave.llm import common, crf


def test_texts_of_a_batch_are_labelled_a_few_at_a_time():
    words = {"x": ["one", "two", "three"], "y": ["uno", "dos", "tres"]}
    model = crf.fit([(name, own * 20) for name, own in words.items() for _ in range(3)], epochs=1)
    texts = pd.Series([" ".join(words["x"] * 60)] * 2_500)  # two million letters, 450,000 words
    labeller = crf.Labeller(model)
    tracemalloc.start()
    judged = [found for held in crf._slices(texts) for found in labeller.judge(held)[1]]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(judged) == len(texts)
    assert peak < 15_000_000


def test_a_task_begins_without_what_another_operator_kept():
    kept = common.once(("other",), lambda: ["large"])
    assert common._KEPT and kept == ["large"]
    seen = []

    @common.tidy
    def work(batches):
        seen.append(list(common._KEPT))
        yield from batches

    assert list(work(iter([1, 2]))) == [1, 2]
    assert seen == [[]]
