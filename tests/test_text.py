import pytest
from pyspark.sql import functions as F

from leadweave.functions import text as T


def one(spark, expr, **cols):
    schema = ", ".join(f"{k} string" for k in cols)
    return spark.createDataFrame([tuple(cols.values())], schema).select(expr.alias("x")).first()[0]


@pytest.mark.parametrize(
    ("value", "host"),
    [
        (" WWW.Firm.NL:8080/p ", "firm.nl"), ("n/a", ""), ("-", ""), ("none", ""), ("", ""), (None, ""), ("info@firma.de", "firma.de"),
        ("firm_a.nl", "firm_a.nl"), ("könyvel.hu", "könyvel.hu"), ("www.www.x.nl", "www.x.nl"), ("http://[::1]/", ""), ("https://u:p@a.b.nl:1/x?y#z", "a.b.nl"), ("\xa0a.nl\n", "a.nl"),
    ],
)
def test_host(spark, value, host):
    assert one(spark, T.host(F.col("v")), v=value) == host


@pytest.mark.parametrize(("site", "mail", "key"), [("gmail.com", "A@gmail.com", "a@gmail.com"), ("gmail.com", None, "gmail.com"), ("x.nl", "a@b.nl", "x.nl"), ("", "a@b.nl", "a@b.nl"), (None, "nope", "")])
def test_lead_key(spark, site, mail, key):
    assert one(spark, T.lead_key(F.col("s"), F.col("m")), s=site, m=mail) == key


def encode(mail, key=0x5A):
    return f"{key:02x}" + "".join(f"{ord(c) ^ key:02x}" for c in mail)


@pytest.mark.parametrize(("hexed", "mail"), [(encode("a.b@c.nl"), "a.b@c.nl"), (encode("X@y.de", 0xFF), "X@y.de"), ("zz", ""), ("5a", ""), ("", ""), (None, ""), ("5a3", "Y"), (encode("a@b.nl")[:-1], "a@b.n" + chr(0x3 ^ 0x5A)), ("5az3", "")])
def test_cf_decode(spark, hexed, mail):
    assert one(spark, T.cf_decode(F.col("h")), h=hexed) == mail


@pytest.mark.parametrize(("tag", "city", "country"), [("2-EN", "", "NL"), ("GULF-EN", "Doha, Qatar", "QA"), ("gulf-turk", None, "AE"), ("PL-EN", "", "PL"), ("", "", ""), (None, None, "")])
def test_campaign_country(spark, tag, city, country):
    assert one(spark, T.campaign_country(F.col("t"), F.col("c")), t=tag, c=city) == country


def test_email_shape(spark):
    for v, ok in [("a@b.nl", True), ("a@b.nl\n", False), ("a@b", False), (None, False), ("a@b.nl c", False)]:
        assert one(spark, T.is_email(F.col("v")), v=v) is ok


def test_join_url(spark):
    assert one(spark, T.join_url(F.col("b"), F.col("p")), b="https://a.nl/x", p="/contact") == "https://a.nl/contact"
    assert one(spark, T.join_url(F.col("b"), F.col("p")), b="https://a.nl/x", p="") == "https://a.nl/x"
