import pytest
from hypothesis import given
from hypothesis import strategies as st

from strandwise.operators.units import Field, convert, convert_units, segment

NM, MGL, MIN, DA, C, P = Field("nM"), Field("mg/L"), Field("minute"), Field("dalton"), Field("celsius", "unit"), Field("nM", "-log")


@pytest.mark.parametrize(
    "field, value, unit, want",
    [
        (NM, "-4.77", "log10(M)", "1.698e+04"), (NM, ">4.30×10^-8 M", None, "4.300e+01"), (NM, "0.002250\xa0umol/L", "", "2.250e+00"), (NM, "Ic50 of 0.25 µmol/l (single run)", None, "2.500e+02"), (NM, "pIC50 = 9.69", None, "2.042e-01"),
        (NM, "1.27 +/- 0.1", " nM ", "1.270e+00"), (NM, "8.9", "-log(mol/L)", "1.259e+00"), (NM, "205", None, None), (NM, "3", "ug/mL", None), (NM, "5", "% inhibition", None), (NM, "29,400,000.0 pmol/L", None, "2.940e+04"), (NM, "4", "mol dm-3", "4.000e+09"), (NM, "7", "NMOL/L", "7.000e+00"),
        (MGL, "162 mg%", None, "1.620e+03"), (MGL, "1.23", "mg per litre", "1.230e+00"), (MGL, "3", "cells/mL", None), (MGL, "3", "%", None), (MGL, "2", "kg m^-3", "2.000e+03"),
        (MIN, "0.08922d", None, "1.285e+02"), (MIN, "87", "s", "1.450e+00"), (MIN, "3,6", "passages", None), (DA, "130 kg/mol", None, "1.300e+05"), (DA, "1280", "residues", None),
        (C, "188.3\xa0F", "", "8.683e+01"), (C, "-3.5", "", "-3.500e+00"), (C, "316.0", "Kelvin", "4.285e+01"), (C, "3", "room", None), (P, "8.54", "", "2.884e+00"), (P, "n.d.", "nM", None), (NM, "", "nM", None),
    ],
)
def test_conversions(field, value, unit, want):
    got = convert(field, "", value, unit)
    assert (None if got is None else "%.3e" % got) == want


@given(st.sampled_from(["nM", "uM", "µM", "μM", "mM", "M", "pmol/L", "nmol/l", "umol/ml"]), st.floats(1e-3, 1e3))
def test_round_trip_of_molar_units(unit, x):
    target = segment("nM")
    own = segment(unit, target.dims)
    there = x * own.factor / target.factor
    assert convert(NM, "", repr(x), unit) == pytest.approx(there) and own.dims == target.dims


@given(st.text(max_size=70))
def test_any_text_ends(text):
    segment(text)
    convert(NM, text, text, text)


def test_operator_on_rows(spark):
    rows = [("a", "f", "t", "5 uM", None, 1), ("a", "f", "t", "5 uM", None, 1), ("b", "f", "t", None, "nM", 2), ("c", None, "t", "5 nM", None, 3), ("d", "g", None, "x" * 50_000 + " 5 nM", None, 4), ("e", "f", "Ki (nM)", "7", "", 5)]
    df = spark.createDataFrame(rows, "id string, field string, term string, value string, unit string, common_unit int")
    got = sorted(tuple(r) for r in convert_units(df, ["id"], "field", "term", "value", "unit", {"f": NM, "g": NM}).collect())
    assert got == [("a", "nM", "5.000e+03"), ("a", "nM", "5.000e+03"), ("d", "nM", "5.000e+00"), ("e", "nM", "7.000e+00")]
    assert convert_units(df.limit(0), ["id"], "field", "term", "value", "unit", {"f": NM}).count() == 0
