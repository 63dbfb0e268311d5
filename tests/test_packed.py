import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandwise.operators.packed import DIALECTS, Dialect, parse, split_packed


def test_parse_quotes_brackets_and_blanks():
    semi = next(d for d in DIALECTS if d.delimiter == ";" and d.quoted)
    assert parse('"a ""x"" b" ; c;"d;e"', semi) == ['a "x" b', "c", "d;e"]
    json = next(d for d in DIALECTS if d.brackets == "[]" and d.quoted)
    assert parse('["a, b", "c \\"q\\""]', json) == ["a, b", 'c "q"']
    brace = next(d for d in DIALECTS if d.brackets == "{}" and not d.quoted)
    assert parse("{a,b}", brace) == ["a", "b"] and parse("a,b", brace) is None


@given(st.lists(st.text(alphabet='ab;"|, ', max_size=8), min_size=1, max_size=5), st.sampled_from([";", "|", ",", "\t"]))
def test_quoted_lists_round_trip(items, delimiter):
    packed = delimiter.join('"' + x.replace('"', '""') + '"' for x in items)
    got = parse(packed, Dialect(delimiter, True, "", False, 0))
    assert got == [x.strip() for x in items]


def corpus(rng):
    """Fields with known values: identifiers, and names that contain separators."""
    name = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(4))
    acc = lambda: f"P{rng.randint(10000, 99999)}"
    forms = [name, name, name, lambda: f"{name()} acid, {rng.randint(2, 9)}-methyl-", lambda: f"{rng.randint(2, 9)},{rng.randint(2, 9)}-di{name()}", lambda: f"{name()}/{name()} complex"]
    rows, want = [], {}
    for i in range(3000):
        kind, make = ("id", acc) if i % 2 else ("name", lambda: rng.choice(forms)())
        values = [make() for _ in range(rng.choice([1, 1, 1, 2, 3]))]
        sep = rng.choice([";", "|", "||", "\t", " | ", "; "] + ([",", "/", " "] if kind == "id" else []))
        rows.append((f"r{i}", kind, sep.join(values)))
        if len(values) > 1:
            want[f"r{i}"] = values
    return rows, want


def test_split_finds_planted_lists(spark):
    rows, want = corpus(random.Random(7))
    df = spark.createDataFrame(rows + rows[:20] + [("n1", "id", None), ("n2", "id", "  "), ("n3", None, "P1"), ("n4", "name", "n/a"), ("long", "id", ";".join(["P12345"] * 20_000))], "rid string, kind string, text string").withColumn("value", F.lit(1))
    got = {}
    for r in split_packed(df, ["rid"], "kind", "text").orderBy("rid", "pos_no").collect():
        got.setdefault(r["rid"], []).append(r["item_value"])
    assert len(got.pop("long")) == 20_000
    assert got == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "rid string, kind string, text string")
    assert split_packed(df, ["rid"], "kind", "text").count() == 0


