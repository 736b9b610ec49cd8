import json
import random
import re
import unicodedata

from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import text as T
from tidemark.operators.canonical import canonicalize, rejected


def canonical(spark, *records):
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "json string").withColumn("item", F.from_json("json", schema.ITEM)).drop("json")
    return canonicalize(df)


# A published record, the digests that its canonical form must have, and the contract's digest.
def test_golden_record_and_contract(spark):
    row = canonical(
        spark,
        {
            "DOI": "10.1016/j.lanwpc.2026.101948", "title": ["Childhood obesity in Pacific Island countries and Territories: from fragmented evidence to coordinated action"], "publisher": "Elsevier BV", "type": "journal-article",
            "issued": {"date-parts": [[2026, 7]]}, "URL": "https://doi.org/10.1016/j.lanwpc.2026.101948", "author": [{"given": "Nicola L.", "family": "Hawley", "ORCID": "https://orcid.org/0000-0002-2601-3454"}],
        },
    ).first()
    assert row.content_hash == "e8f0fd5a06a602e4500383bec56fc8fe9129ea066123daf8cb36689251d6d330"
    assert row.author_hash == "5027dfdfca59434bf95f9297242c4d147d8f8a732f8147702a6354984563218a"
    assert schema.CONTRACT_HASH == "660432b99f6ec7e837df1930fb0d8e7999c65d1f0e6fee8947b72d6389b60dc8"


def plainly(text):
    """The rule for a text value, in plain Python: composed, control signs and blanks off both ends, runs of white space one blank."""
    if text is None:
        return None
    text = re.sub(r"[\x09-\x0d\x20]+", " ", unicodedata.normalize("NFC", text).strip("".join(map(chr, range(33)))))
    return text or None


def test_text_values_follow_the_rule(spark):
    r = random.Random(8)
    signs = [*"aBz9", " ", "  ", "\t", "\n", "\r\n", "\x0b", "\u00a0", "\u2003", "e\u0301", "\u212b", "\U0001d11e", "\ufb01", "\u1112\u1161\u11ab"]
    values = ["".join(r.choice(signs) for _ in range(r.randrange(9))) for _ in range(150)] + [None, "", " \n\t "]
    rows = canonical(spark, *({"DOI": f"10.2/{k}", "title": [v], "publisher": v, "type": v, "author": [{"given": v, "family": "F"}]} for k, v in enumerate(values))).collect()
    for row in rows:
        want = plainly(values[int(row.doi.split("/")[1])])
        assert (row.title, row.publisher, json.loads(row.authors_json)[0]["given"]) == (want, want, want)
        assert row.work_type == (want.lower() if want else None)


def test_the_first_title_that_says_something_is_taken(spark):
    lists = [None, [], [None], ["", None, "\t"], [None, " ", "Second", "Third"], ["\u00a0", "After a no-break space"]]
    rows = {r.doi: r.title for r in canonical(spark, *({"DOI": f"10.3/{k}", "title": t} for k, t in enumerate(lists))).collect()}
    for k, t in enumerate(lists):
        assert rows[f"10.3/{k}"] == next((plainly(x) for x in t or [] if plainly(x)), None)


def test_what_content_depends_on(spark):
    people = [{"given": f"G{k}", "family": f"F{k}", "ORCID": None} for k in range(4)]
    base = {"DOI": "10.4/Q", "title": ["t"], "publisher": "P", "type": "book", "issued": {"date-parts": [[1999, 12]]}, "URL": "u", "author": people}
    same = [{"created": {"date-time": "2001-01-01T00:00:00Z"}}, {"DOI": " 10.4/q\n"}, {"author": [None, *people, None]}, {"title": ["t", "another"]}, {"type": "BOOK "}]
    other = [{"author": people[::-1]}, {"author": people[:3]}, {"author": None}, {"publisher": None}, {"issued": {"date-parts": [[1999, 12, 1]]}}, {"URL": "v"}, {"DOI": "10.4/r"}]
    rows = canonical(spark, base, *({**base, **x} for x in same + other))
    first, *rest = [r.content_hash for r in rows.select("content_hash").collect()]
    assert rest[: len(same)] == [first] * len(same) and first not in rest[len(same) :] and len(set(rest[len(same) :])) == len(other)


def test_odd_dates_and_rejects(spark):
    rows = canonical(spark, {"DOI": "1", "issued": {"date-parts": [[None]]}}, {"DOI": "1", "issued": {"date-parts": [[1, 2, 3, 4]]}}, {"DOI": "1", "issued": {"date-parts": []}}, {"DOI": "1", "issued": {"date-parts": [[26, 13, 45]]}}, {"title": ["t"]})
    assert [(r.issued_date, r.issued_date_precision) for r in rows.collect()][:4] == [("null", 1), (None, None), (None, None), ("0026-13-45", 3)]
    assert rejected(rows).count() == 5


def test_text_functions(spark):
    df = spark.createDataFrame([("\x01 a  \t b\n",), (None,), ("  ",)], "t string")
    assert [r[0] for r in df.select(T.plain(F.col("t"))).collect()] == ["a  b", None, None]
    assert [r[0] for r in df.select(T.doi_key(F.lit(" A  B "))).limit(1).collect()] == ["a  b"]
    u = "01234567-89ab-cdef-0123-456789abcdef"
    assert df.select(T.uuid_text(T.uuid_bytes(F.lit(u)))).first()[0] == u
