import pytest
from pyspark.sql import functions as F

from leadweave.operators.bad_records import assemble_records, field_fault, loaded, parse_records, split_record

OK = "NL,Firm,a@b.nl,b.nl,https://b.nl/x"


def reason(record):
    fields, why = split_record(record)
    return why or field_fault(fields)


@pytest.mark.parametrize(
    ("record", "why"),
    [
        (OK, None), (OK + "\r\n", None), (OK + "\n", None), (OK + "\r", None), (OK + "\n\n", None), ("", "columns"), (None, "columns"),
        ('NL,"Firm, the",a@b.nl,,', None), ('NL,"Firm\nsecond",a@b.nl,,', None), ('NL,"A ""B"" C",a@b.nl,-,', None), ('NL,"A"B,a@b.nl,,', "quoting"),
        ('NL,A "B",a@b.nl,,', "quoting"), ('NL,"open,a@b.nl,,', "quoting"), ('NL, "A",a@b.nl,,', "quoting"), ("NL,A\nB,a@b.nl,,", "columns"), ("NL,A,a@b.nl,", "columns"), (OK + ",x", "columns"),
        ('a,b,c"d', "quoting"), ("NL,F,a@b,b.nl,", "email"), ("NL,F, a@b.nl ,b.nl,", None), ("NL,F,a@b.nl.,b.nl,", "email"), ("NL,F,a@b.nl; c@d.nl,,", "email"),
        ("NL,F,a@b.nl,ftp://b.nl,", "website"), ("NL,F,a@b.nl,N/A,", None), ("NL,F,a@b.nl,b,", "website"), ("NL,F,a@b.nl,b..nl,", "website"), ("NL,F,a@b.nl,-b.nl,", "website"),
        ("NL,F,a@b.nl,b.nl:123456,", "website"), ("NL,F,a@b.nl,HTTPS://B.nl:80?x,", None), ("NL,F,a@b.nl,b.nl/a b,", "website"), ("NL,F,a@b.nl,b.nl,b.nl/x", "source_url"), ("NL,F,a@b.nl,b.nl,n/a", "source_url"),
    ],
)
def test_reason(record, why):
    assert reason(record) == why


def test_parse_keeps_rows_and_replaces_clashing_columns(spark):
    df = spark.createDataFrame([(1, OK, "r", "list-07.csv"), (2, None, None, None), (1, OK, "r", "list-07.csv"), (3, "x" * 200_000, "r", "f")], "line_no long, raw_line string, reason string, file_name string").withColumn("arrived_at", F.lit(None).cast("timestamp"))
    got = parse_records(df)
    assert sorted((r.line_no, r.reason) for r in got.collect()) == sorted([(1, None), (1, None), (2, "columns"), (3, "columns")], key=str)
    rows = loaded(got).collect()
    assert len(rows) == 2 and rows[0].list_no == 7 and rows[0].company == "Firm"
    assert parse_records(df.limit(0)).count() == 0


def test_assemble(spark):
    text = ["a,b", 'c,"d', "e", 'f",g', "h", 'i,"j""', 'k"', "", 'l,"open']
    rows = [("f", n, t) for n, t in enumerate(text)] + [("g", 0, 'x,"'), ("g", 1, '"'), ("g", 2, None)]
    df = spark.createDataFrame(rows, "file string, line_no int, line string")
    for block in (1, 2, 1000):
        got = {(r.file, r.first_line): r.raw_line for r in assemble_records(df, block=block).collect()}
        assert got == {("f", 0): "a,b", ("f", 1): 'c,"d\ne\nf",g', ("f", 4): "h", ("f", 5): 'i,"j""\nk"', ("f", 7): "", ("f", 8): 'l,"open', ("g", 0): 'x,"\n"', ("g", 2): ""}
