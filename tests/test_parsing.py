from kinweave.operators import parsing

GOOD = ["q", "s", "97.5", "10", "0", "0", "1", "10", "2", "11", "1e-5", "50.1"]


def line(**changes):
    cells = list(GOOD)
    for k, v in changes.items():
        cells[int(k[1:])] = v
    return "\t".join(cells)


VALID = [
    line(), line() + "\r\n", line(c10="e-30"), line(c10="E+3"), line(c11="+8.5"), line(c11=".5"), line(c11="5."), line(c2="100"), line(c10="-0"),
    line(c0='"q\tx"'), line(c0='"a ""b"" c"'), line(c0=' "q" '), line(c10=" 1e-5 "), "\t".join(f'"{c}"' for c in GOOD), line(c0='""""'), line(c3="9" * 40), line(c0="q's#"),
]
BROKEN = {
    line(c0=""): ["query_id: empty id"], line(c1='""'): ["subject_id: empty id"], line(c0='" \t"'): ["query_id: empty id"], line(c2="100.1"): ["percent_identity: too large"], line(c2="-1"): ["percent_identity: too small"],
    line(c6="0"): ["q_start: too small"], line(c4="-1"): ["mismatch: not digits"], line(c4="1e3"): ["mismatch: not digits"], line(c10="nan"): ["evalue: not a number"], line(c10="1,5"): ["evalue: not a number"],
    line(c11="e5"): ["bits: not a number"], line(c11="-0.1"): ["bits: too small"], line(c11="-"): ["bits: not a number"], line(c11="1 5"): ["bits: not a number"], line(c11=""): ["bits: not a number"],
    line() + "\t": ["too many fields"], "\t".join(GOOD[:11]): ["too few fields"], "a,b": ["too few fields"], line(c0='"q'): ["stray quote"], line(c0='q"x'): ["stray quote"], line(c0='"q"x'): ["stray quote"],
    line(c0='x"q"'): ["stray quote"], line(c0='"a" "b"'): ["stray quote"], line(c2="x", c11="y"): ["bits: not a number", "percent_identity: not a number"],
}
NONE = [None, "", "   ", "\t\t", "# comment", "\r\n"]


def test_valid_broken_and_no_records(spark):
    texts = VALID + list(BROKEN) + NONE
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[::3], "line_id bigint, line string, cells string")
    cells = parsing.parsed(df)
    found = {texts[r.row]: r.reasons for r in parsing.errors(cells, spark).collect()}
    assert found == BROKEN
    clean = {texts[r.row]: r for r in parsing.clean(cells, spark).collect()}
    assert set(clean) == set(VALID)
    assert clean[line(c10="e-30")].evalue == 1e-30
    assert clean[line(c0='"q\tx"')].query_id == "q\tx"
    assert clean[line(c0='"a ""b"" c"')].query_id == 'a "b" c'
    long = clean[line(c3="9" * 40)]
    assert long.length is None and long.beyond == "length=" + "9" * 40 and clean[line()].beyond == ""


def test_very_long_lines_and_empty_table(spark):
    long = [(1, "x" * 2_000_000), (2, '"' + 'a""' * 200_000 + '"' + "\t1" * 11), (3, "\t".join(["7"] * 100_000))]
    cells = parsing.parsed(spark.createDataFrame(long, "line_id bigint, line string"))
    assert {r.row: r.reasons for r in parsing.errors(cells, spark).collect()} == {1: ["too few fields"], 3: ["too many fields"]}
    none = parsing.parsed(spark.createDataFrame([], "line_id bigint, line string"))
    assert parsing.errors(none, spark).count() == 0 and parsing.clean(none, spark).count() == 0
