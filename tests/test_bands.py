"""The grammar of band names: forms, selection, renaming and audits of single products."""

import pytest

from changegrid.operators import bands as N

DATES = [("p", "22Sep2023", True), ("p", "04Oct2023", False), ("p", "16Oct2023", False)]
COREG = [f"{c}_VV_{role}" for role in ("mst_22Sep2023", "slv1_04Oct2023", "slv2_16Oct2023") for c in "iq"]
IFG = [f"{c}_ifg_VV_22Sep2023_{d}" for d in ("04Oct2023", "16Oct2023") for c in "iq"] + list(N.ANCILLARY)


def inventory(spark, names, product="p"):
    return spark.createDataFrame([(product, n, k) for k, n in enumerate(names)], "product_id string, band_name string, position int")


def expected(spark):
    return spark.createDataFrame(DATES, "product_id string, token string, master boolean")


def found(df):
    return sorted((r.problem, r.detail) for r in df.collect())


def test_forms_and_final_names(spark):
    names = ["i_VV_slv1_04Oct2023_slv3_22Sep2023", "q_ifg_VV_22Sep2023_04Oct2023_slv4_22Sep2023", "q_ifg_VV_22Sep2023_04Oct2023_slv4_23Sep2023", "i_VV_mst_22Sep2023", "q_VH_slv12_04Oct2023", "elevation", "i_ifg_VH_22Sep2023_04Oct2023"]
    got = {r.band_name: (r.form, r.component, r.pol, r.date, r.of, r["index"], r.name) for r in N.parse_names(inventory(spark, names)).withColumn("name", N.final_name()).collect()}
    assert got[names[0]] == ("stacked_slave", "i", "VV", "04Oct2023", "22Sep2023", "3", "i_VV_slv3_04Oct2023")
    assert got[names[1]] == ("stacked_ifg", "q", "VV", "04Oct2023", "22Sep2023", "4", "q_ifg_VV_22Sep2023_04Oct2023")
    assert got[names[2]][0] is None and got["elevation"][:2] == (None, None)
    assert got[names[3]][:4] == ("master", "i", "VV", "22Sep2023") and got[names[4]][:3] == ("slave", "q", "VH") and got[names[6]][:3] == ("ifg", "i", "VH")


def test_audit_of_coregistered_stacks(spark):
    want = expected(spark)
    assert found(N.audit_coreg(inventory(spark, COREG), want)) == []
    spoilt = [*COREG[:5], "i_VV_slv9_04Oct2023", "q_VH_slv2_16Oct2023", "q_VV_slv3_28Oct2023", "i_VV_mst_04Oct2023", "coh_VV", "i_VV_slv1_16Oct2023_slv2_22Sep2023"]
    assert found(N.audit_coreg(inventory(spark, spoilt), want)) == sorted([
        ("repeat", "i_VV_slv9_04Oct2023"), ("pol", "q_VH_slv2_16Oct2023"), ("date", "q_VV_slv3_28Oct2023"), ("date", "i_VV_mst_04Oct2023"), ("band", "coh_VV"),
        ("form", "i_VV_slv1_16Oct2023_slv2_22Sep2023"), ("pair", "16Oct2023"), ("count", "11"),
    ])
    assert found(N.audit_coreg(inventory(spark, []), want)) == [("count", "0"), *[("pair", d) for _, d, _ in sorted(DATES, key=lambda x: x[1])]]


def test_audit_of_interferograms(spark):
    want = expected(spark)
    assert found(N.audit_ifg(inventory(spark, [*IFG, "coh_VV"]), want)) == []
    spoilt = [*IFG[:3], "i_ifg_VV_22Sep2023_04Oct2023", "q_ifg_VH_22Sep2023_16Oct2023", "q_ifg_VV_23Sep2023_16Oct2023", "q_ifg_VV_22Sep2023_28Oct2023", "elevation", "elevation", "orthorectifiedLat"]
    assert found(N.audit_ifg(inventory(spark, spoilt), want)) == sorted([
        ("repeat", "i_ifg_VV_22Sep2023_04Oct2023"), ("pol", "q_ifg_VH_22Sep2023_16Oct2023"), ("master", "q_ifg_VV_23Sep2023_16Oct2023"), ("date", "q_ifg_VV_22Sep2023_28Oct2023"),
        ("pair", "16Oct2023"), ("ancillary", "elevation"), ("ancillary", "orthorectifiedLon"),
    ])


def test_selection(spark):
    """One pair a date is kept, the first; stacked names are renamed; a date without its pair is an error."""
    names = ["i_VV_slv5_04Oct2023", *COREG[:4], "i_VV_slv1_16Oct2023_slv2_22Sep2023", "q_VV_slv1_16Oct2023_slv2_22Sep2023", "q_VV_slv7_16Oct2023", "i_VH_mst_22Sep2023"]
    picked = N.require_pairs(N.select_final(inventory(spark, names), expected(spark)), expected(spark))
    assert {r.band_name: r.final_name for r in picked.collect()} == {
        "i_VV_slv5_04Oct2023": "i_VV_slv5_04Oct2023", "i_VV_mst_22Sep2023": "i_VV_mst_22Sep2023", "q_VV_mst_22Sep2023": "q_VV_mst_22Sep2023", "q_VV_slv1_04Oct2023": "q_VV_slv1_04Oct2023",
        "i_VV_slv1_16Oct2023_slv2_22Sep2023": "i_VV_slv2_16Oct2023", "q_VV_slv1_16Oct2023_slv2_22Sep2023": "q_VV_slv2_16Oct2023",
    }
    with pytest.raises(ValueError, match="16Oct2023"):
        N.require_pairs(N.select_final(inventory(spark, COREG[:5]), expected(spark)), expected(spark))
    names = lambda df: {r.band_name for r in df.collect()}
    both = inventory(spark, [*COREG, *IFG, "i_VH_mst_22Sep2023", "coh_VV_x"])
    assert names(N.select_export(both, "coreg")) == {*COREG, *IFG[:4]} and names(N.select_export(both, "ifg")) == set(IFG)
    assert names(N.select_export(both, "coreg", stack_input=True)) == set(COREG[2:]) and names(N.select_export(both, "ifg", stack_input=True)) == set(IFG[:4])
    assert names(N.select_export(inventory(spark, COREG), "ifg", stack_input=True)) == set(COREG[2:])
    with pytest.raises(ValueError, match="no band to export"):
        N.require_selected(N.select_export(both, "ifg", "HH", True), both)
    with pytest.raises(ValueError, match="coreg or ifg"):
        N.select_export(both, "other")
