"""Rounds of pointer doubling: pointers never pass the driver."""

from __future__ import annotations

from helpers import plan, rows

from clinspark.operators.vocabulary import follow_to_end
from clinspark.staging import Staging


class Watched(Staging):
    plans: list[str] = []

    def table(self, df, name=None):
        self.plans.append(plan(df))
        return super().table(df, name)


def test_pointers_are_no_broadcast(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(9)] + [(20, 21), (21, 20)], "node bigint, next bigint")
    watched = Watched(spark)
    got = rows(follow_to_end(links, watched))
    assert got == sorted([(i, 9, 9 - i) for i in range(9)] + [(20, None, None), (21, None, None)], key=lambda r: str(r[0]))
    rounds = [p for p in watched.plans if "Join" in p]
    assert len(rounds) >= 4 and not any("Broadcast" in p for p in rounds)
