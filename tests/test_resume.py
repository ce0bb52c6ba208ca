"""A run of all stages that was cut off goes on after the stages it finished."""

import pytest

from gridloom.plans import jobs
from gridloom.sources.reports import write_text
from gridloom.sources.scratch import scratch_path

STAGES = ["run_clean", "run_prepare", "run_search", "run_importance", "run_train", "run_baseline", "run_baseline", "run_evaluate"]


def test_finished_stages_are_not_computed_again(spark, monkeypatch):
    calls, dies = [], {"run_train"}

    def stage(name):
        def run(*args, **kwargs):
            calls.append(name)
            if name in dies:
                raise KeyboardInterrupt
            return {"done": True}

        return run

    for name in set(STAGES):
        monkeypatch.setattr(jobs, name, stage(name))
    folder = scratch_path(spark, "all")
    source = write_text(spark, f"{folder}/raw.csv", "a,b\n1,2\n")
    with pytest.raises(KeyboardInterrupt):
        jobs.run_all(spark, source, folder, resume=True)
    assert calls == STAGES[:5]
    calls.clear()
    dies.clear()
    assert jobs.run_all(spark, source, folder, resume=True) == {"done": True} and calls == STAGES[4:]
    calls.clear()
    jobs.run_all(spark, source, folder, resume=True)
    assert calls == ["run_evaluate"]
    calls.clear()
    jobs.run_all(spark, source, folder, resume=True, seed=7)
    assert calls == STAGES
    calls.clear()
    write_text(spark, source, "a,b\n1,2\n3,4\n")
    jobs.run_all(spark, source, folder, resume=True, seed=7)
    assert calls == STAGES
    calls.clear()
    jobs.run_all(spark, source, folder)
    assert calls == STAGES
