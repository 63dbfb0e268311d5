from strandwise.operators.units import segment


def test_a_long_spelling_is_read_to_its_end():
    long = "mol/L" + "*mol/mol" * 12
    assert len(long) > 64 and segment(long).dims == segment("mol/L").dims and segment(long).factor == segment("mol/L").factor
    assert segment(long + "*qq") is None
