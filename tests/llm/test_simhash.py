from __future__ import annotations

import random

import pytest

from laneforge.llm import common, simhash


@pytest.mark.parametrize("hot", [simhash.HOT, 1])
def test_exploded_keys_are_not_broadcast(spark, monkeypatch, hot):
    """A fingerprint has 64 variants and thousands of star keys; however few fingerprints there are, these don't go through the driver."""
    draw, ran = random.Random(5), []
    apart = [draw.getrandbits(63) for _ in range(40)]
    fps = common.saved(spark.createDataFrame([(f ^ turned,) for f in apart for turned in (0, 1, 3 << 40)], "fp long"))

    def kept(df, name="rows"):
        ran.append(df)
        return common.saved(df)

    monkeypatch.setattr(simhash, "saved", kept)
    monkeypatch.setattr(simhash, "stored", kept)
    found = {tuple(r) for r in simhash.links(fps, hot).collect()}
    near = {(min(f ^ a, f ^ b), max(f ^ a, f ^ b)) for f in apart for a, b in ((0, 1), (0, 3 << 40), (1, 3 << 40))}
    assert found <= near and {x for pair in found for x in pair} == {x for pair in near for x in pair}
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in ran]
    exploded = [p for p in plans if "Generate explode" in p]
    assert len(exploded) == 2 and not any("Broadcast" in p for p in exploded)
