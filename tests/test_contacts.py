from pyspark.sql import functions as F

from barstream.operators import contacts as C
from barstream.sources.schemas import CARD

EMPTY = ("", "", "", "", "", "", "", 0)


def test_vcard_bytes(spark, tmp_path):
    rows = [("李雷", "", "工程师", "13800000000", "a@b.c", "公司", "  ", 1), EMPTY]
    df = spark.createDataFrame(rows, CARD).withColumn("id", F.monotonically_increasing_id())
    got = [r["vcard"] for r in C.vcards(df, "id").orderBy("id").collect()]
    assert got[0] == (
        "BEGIN:VCARD\r\nVERSION:3.0\r\nTEL;TYPE=CELL:13800000000\r\nEMAIL:a@b.c\r\nFN;CHARSET=UTF-8:李雷\r\n"
        "ORG;CHARSET=UTF-8:公司\r\nTITLE;CHARSET=UTF-8:工程师\r\nEND:VCARD\r\n"
    )
    assert got[1] == "BEGIN:VCARD\r\nVERSION:3.0\r\nEND:VCARD\r\n"
    C.write_vcards(df.limit(1), str(tmp_path / "v"), "id")
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "v").glob("part-*")))
    assert data == got[0].encode("utf-8")


def test_empty_and_filled(spark):
    rows = [EMPTY, ("", "", "", "", "", "", "　\n", 2), ("", "content://x", "", "", "", "", "", 0), (None,) * 8, ("n", *[None] * 6, 7)]
    df = spark.createDataFrame(rows, CARD)
    assert C.nonempty_contacts(df).count() == 2
    filled = C.fill_contacts(df).collect()
    assert all(v is not None for r in filled for v in r)
    assert [r["templateIndex"] for r in filled] == [0, 2, 0, 0, 0]


def test_latest_write_of_each_field_wins(spark):
    full = lambda key, seq, name, template: (key, seq, name, "", "", "", "", "", "", template)
    patch = lambda key, seq, template: (key, seq, *[None] * 7, template)
    schema = "id int, seq int, " + ", ".join(f"{c} string" for c in C.TEXT_FIELDS) + ", templateIndex int"
    rows = [full(1, 1, "old", 0), patch(1, 2, 2), full(2, 1, "x", 0), patch(2, 2, 1), full(2, 3, "y", 0), patch(3, 1, 1)]
    out = {r["id"]: r for r in C.fold_contacts(spark.createDataFrame(rows, schema), "id").collect()}
    assert (out[1]["name"], out[1]["templateIndex"]) == ("old", 2)
    assert (out[2]["name"], out[2]["templateIndex"]) == ("y", 0)
    assert (out[3]["name"], out[3]["templateIndex"]) == (None, 1)


def test_profile(spark):
    rows = [("李雷", "", "", "1", " ", "c", "", 0), ("  x", "content://x", "", "1", "e", "c", "", 0), ("  ", "", "", "", "", "", "", 0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CARD.fields))
    got = [(r["filled_lines"], r["initial"]) for r in C.contact_profile(df, "id").orderBy("id").collect()]
    assert got == [(2, "李"), (3, None), (0, "")]
