"""Several stacks at once: their pixel keys are unrelated."""

import glob
import os

import duckdb
import pytest

from changegrid.config import Psi
from changegrid.operators import psi
from changegrid.plans import queries_points
from changegrid.plans.pipelines import run_psi
from changegrid.plans.queries import ORACLE_SQL, QUERIES

COLUMNS = "stack_id string, azimuth_index long, range_index long, ci_emergence double, break_after string, break_before string, cdpsi_class string"


@pytest.mark.parametrize("stacks", [1, 2, 3])
def test_one_candidate_a_pixel_of_each_stack(spark, stacks):
    rows = [(f"s{k}", 1, 1, 0.5 + k, "2023-01-01", "2023-02-01", "emergence_candidate") for k in range(stacks)]
    rows += [("s0", 1, 1, 0.5, "2022-12-01", "2023-02-01", "emergence_candidate"), ("s0", 1, 1, 9.0, "2022-01-01", "2023-02-01", "stable")]
    got = psi.emergence_points(spark.createDataFrame(rows, COLUMNS), ["stack_id"]).collect()
    assert sorted((r.stack_id, r.ci_emergence, r.break_before) for r in got) == [(f"s{k}", 0.5 + k, "2023-02-01") for k in range(stacks)]
    assert [r.break_after for r in got if r.stack_id == "s0"] == ["2022-12-01"]  # of equal values the earlier break
    none = spark.createDataFrame([], COLUMNS)
    assert psi.emergence_points(none, ["stack_id"]).count() == 0


def table(stack, shift, weak):
    """45 scatterers of a stack, five of which emerge at the pixels (40..44, 1)."""
    out = []
    for i in range(45):
        new = i >= 40
        for subset, tc in ((None, 0.2 if new else 0.82 + i * 1e-4), ("front", 0.18 if new else 0.83), ("back", (0.9 if weak else 0.95) if new else 0.81 + i * 1e-4)):
            out.append((stack, subset and f"{stack}-{subset}", i, i, 1, tc, i * 100.0 + shift, 0.0))
    return out


def test_run_psi_over_stacks(spark):
    """Two stacks give what each gives alone, joined."""
    schema = "stack_id string, subset_id string, point_id long, azimuth_index long, range_index long, temporal_coherence double, x double, y double"
    plan = "stack_id string, front_id string, back_id string, break_after string, break_before string"
    parts = {"a": table("a", 0.0, False), "b": table("b", 5.0, True)}
    breaks = [(s, f"{s}-front", f"{s}-back", "2023-09-10", "2023-09-22") for s in parts]
    rows = lambda names: run_psi(spark.createDataFrame([r for n in names for r in parts[n]], schema), spark.createDataFrame([b for b in breaks if b[0] in names], plan), cfg=Psi(cluster_buffer_m=10.0), outlines=False)
    both = rows("ab")
    alone = [(r.stack_id, r.point_id, round(r.ci_emergence, 9)) for n in "ab" for r in rows(n)["emergence"].collect()]
    assert sorted((r.stack_id, r.point_id, round(r.ci_emergence, 9)) for r in both["emergence"].collect()) == sorted(alone) and len(alone) == 10
    summary = both["summary"].first()
    assert summary.points == 10 and summary.polygons == 5 and summary.stacks == ["a", "b"]


def test_indices_are_those_of_sql_to_the_last_digit(spark):
    """The sixth digit, where a half is rounded, too: an index must be worked out by the same steps."""
    data, con = "/root/testdata/sf0.01", duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.sql(ORACLE_SQL["stacks_emergence"])
    got = QUERIES["stacks_emergence"](spark, data).select(want.columns).collect()
    assert sorted(tuple(r) for r in got) == sorted(want.fetchall())


def test_pipeline_takes_the_steps_of_its_sql(spark):
    """Its SQL scales the coherence and then takes the index, so an index is the difference of the coherences, to the last bit."""
    rows = queries_points.fused_points(spark, "/root/testdata/sf0.001").select("ci_emergence", "tc_back", "tc_complete", "break_after").collect()
    assert len({r.break_after for r in rows}) > 1
    assert all(r.ci_emergence == r.tc_back - r.tc_complete for r in rows)
