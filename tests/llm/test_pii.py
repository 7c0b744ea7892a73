"""Permutations are bijections that the key takes back; formats stay valid; equal values stay linked."""

import datetime
import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tabspark.llm import pii


def luhn(number):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(number))) % 10 == 0


@pytest.mark.parametrize("a,b", [(pii.DAYS[0], pii.DAYS[1]), (10, 100), (1, 7), (100, 100)])
def test_bijection(spark, a, b):
    x, y = F.lit(a).cast("bigint"), F.lit(b).cast("bigint")
    p = spark.range(a * b).select("id", pii.permuted(F.col("id"), x, y, "key", "k").alias("p"), pii.permuted(F.col("id"), x, y, "other", "k").alias("o"))
    n, least, most, back, moved = p.agg(F.countDistinct("p"), F.min("p"), F.max("p"), F.sum((pii.restored(F.col("p"), x, y, "key", "k") == F.col("id")).cast("int")), F.sum((F.col("p") != F.col("o")).cast("int"))).first()
    assert (n, least, most, back) == (a * b, 0, a * b - 1, a * b)
    assert a * b < 1000 or moved > 0.9 * a * b


def treated(spark, texts, key="k"):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string").selectExpr("*", "1 AS found", "2 AS source")
    return {r["doc_id"]: r for r in pii.pseudonymised(docs, key).collect()}


def test_formats(spark):
    texts = ["4041894974608795", "4041-8949-7460-8795 and 4041 8949 7460 8795", "4041894974608796", "378282246310005", "1987-02-28 28.02.1987 02/28/1987 1987/02/28", "1987-02-30 13/13/2000", "+1 (017) 555-7713", "017-555-7713",
             "157.212.123.28.", "1.2.3.4.5 256.1.1.1", "123-45-6789", "666-45-6789 000-12-3456 123-00-4567", "a.b@c.example", "v1987-02-28x"]
    got = treated(spark, texts)
    new = [got[i]["text"] for i in range(len(texts))]
    assert luhn(new[0]) and len(new[0]) == 16 and new[0] != texts[0]
    assert [re.sub("[^0-9]", "", x) for x in new[1].split(" and ")] == [new[0]] * 2 and re.fullmatch(r"(\d{4}-){3}\d{4} and (\d{4} ){3}\d{4}", new[1])
    assert new[2] == texts[2] and luhn(new[3]) and len(new[3]) == 15
    day = datetime.date.fromisoformat(new[4].split()[0])
    assert new[4].split() == [day.isoformat(), day.strftime("%d.%m.") + f"{day.year:04d}", day.strftime("%m/%d/") + f"{day.year:04d}", day.isoformat().replace("-", "/")] and 1700 <= day.year < 2100
    assert new[5] == texts[5]
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", new[6]) and re.sub("[^0-9]", "", new[6])[1:] == re.sub("[^0-9]", "", new[7])
    assert all(0 <= int(x) < 256 for x in new[8].rstrip(".").split(".")) and new[8] != texts[8] and new[9] == texts[9]
    area, group, serial = new[10].split("-")
    assert area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000" and new[10] != texts[10] and new[11] == texts[11]
    assert new[12].endswith("@c.example") and "a.b" not in new[12] and new[13] == texts[13]
    for i, r in got.items():
        for s in r["pii"]:
            assert s["pseudonym"] in r["text"] and texts[i][s["start"]:s["end"]] not in ("", s["pseudonym"])
    assert [treated(spark, texts, "another")[i]["text"] for i in (0, 8)] != [new[0], new[8]]


def test_odd_inputs(spark):
    got = treated(spark, [None, "", "é 😀 1.2.3.4 ü", "x " * 200_000 + "10.0.0.1", "no digits"])
    assert got[0]["text"] is None and got[1]["text"] == "" and got[0]["pii"] == [] and got[4]["text"] == "no digits"
    assert [(s["kind"], s["start"], s["end"]) for s in got[2]["pii"]] == [("address", 4, 11)] and got[2]["text"].startswith("é 😀 ") and got[2]["text"].endswith(" ü")
    assert got[3]["pii"][0]["start"] == 400_000
    docs = spark.createDataFrame([], "doc_id int, text string")
    assert pii.pseudonymised(docs, "k").collect() == []


def test_documents_keep_everything_else(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    done = {r["doc_id"]: r for r in pii.pseudonymised(docs, "k").collect()}
    cards, links = 0, {}
    for r in docs.collect():
        new, at, out = done[r["doc_id"]], 0, ""
        for s in new["pii"]:
            out += r["text"][at:s["start"]] + s["pseudonym"]
            at = s["end"]
            old = r["text"][s["start"]:s["end"]]
            assert links.setdefault(old, s["pseudonym"]) == s["pseudonym"]
            cards += s["kind"] == "card"
        assert out + r["text"][at:] == new["text"]
        for m in re.findall(r"[\w.+-]+@[\w.-]+\w|\+1 \(\d{3}\) \d{3}-\d{4}|(?<![\d.])\d+\.\d+\.\d+\.\d+", r["text"]):
            assert m in links
        assert (new["lang"], new["source"]) == (r["lang"], r["source"])
    assert cards > 0 and len(set(links.values())) == len(links)
