"""Leaks against a plain comparison of template windows; other values, inconsistent values, odd inputs."""

import textwrap
from collections import defaultdict

import pytest
import regex
from conftest import SF

from tabspark.llm import decontam


def raw(text):
    text = regex.sub(r"[ \t\n\x0B\f\r]+", " ", (text or "").replace("@", " "))
    for _ in range(2):
        text = regex.sub(r"([\p{Ll},;] )(\p{Lu}\p{Ll}+)", r"\1@\2", text)
    return regex.findall(r"\p{N}+(?:[.,]\p{N}+)*|[\p{L}\p{M}@]+", text.lower())


def canon(words):
    return ["#" if w < ":" else "@" if w < "A" else "%" if w in decontam.UNITS and i and words[i - 1] < ":" else w for i, w in enumerate(words)]


def stretches(at, width, alike):
    """The sorted places in groups: a word that differs ends one."""
    groups = []
    for p in sorted(at):
        if groups and all(alike(q) for q in range(groups[-1][-1] + width, p)):
            groups[-1].append(p)
        else:
            groups.append([p])
    return groups


def brute(docs, items):
    out = {}
    for d, text in docs:
        dr = raw(text)
        dt, dp = canon(dr), [w.lstrip("@") for w in dr]
        for item, question in items:
            ir = raw(question)
            it, ip = canon(ir), [w.lstrip("@") for w in ir]
            width = min(decontam.WINDOW, len(it))
            places = range(len(it) - width + 1) if it else ()
            literal = {p for p in places if sum(x not in "#%@" for x in it[p:p + width]) >= decontam.WINDOW // 2}
            named = ["@"] + it[1:width] if ir and ir[0] >= "A" else None
            used = {p for p in places if p in literal or p == 0 and named and sum(x not in "#%@" for x in named) >= decontam.WINDOW // 2}
            whole = {p for p in places if width == decontam.WINDOW or p in literal}
            found = defaultdict(lambda: (set(), set()))
            by_plain, by_template = defaultdict(set), defaultdict(set)
            for p in whole:
                by_plain[tuple(ip[p:p + width])].add(p)
            for p in literal:
                by_template[tuple(it[p:p + width])].add(p)
            if named and 0 in used:
                by_template[tuple(named)].add(0)
            for a in range(len(dt) - width + 1 if it else 0):
                for p in by_plain.get(tuple(dp[a:a + width]), ()):
                    found[a - p][1].add(p)
                for p in by_template.get(tuple(dt[a:a + width]), ()):
                    found[a - p][0].add(p)
            best = None
            for shift, (at, same) in found.items():
                if any(same.issuperset(range(p, p + min(decontam.ENOUGH, len(whole)))) for p in same):
                    got = (len(same), -(shift + min(same)), True, len(whole))
                elif at and len(at) >= min(decontam.ENOUGH, len(used)):
                    kept, equal = [], True
                    for group in stretches(at, width, lambda q: it[q] == dt[q + shift]):  # noqa: B023
                        slots = {(ir[p], dr[p + shift]) for p in range(group[0], group[-1] + width) if it[p] in "#%@"}
                        if len(slots) == len({a for a, _ in slots}):
                            kept += group
                            equal &= all(a == b for a, b in slots)
                    if not kept or len(kept) < min(decontam.ENOUGH, len(used)):
                        continue
                    got = (len(kept), -(shift + min(kept)), equal, len(used))
                else:
                    continue
                best = max(best or (-1,), got)
            if best:
                out[d, item] = (best[0], best[0] / best[3], -best[1], best[2])
    return out


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id int, text string").selectExpr("*", "1 AS item_id", "2 AS raw", "3 AS bad", "4 AS words")
    b = spark.createDataFrame(items, "item_id int, text string").selectExpr("*", "1 AS doc_id", "2 AS hash")
    return {(r["doc_id"], r["item_id"]): (r["n_windows"], r["coverage"], r["start"], r["verbatim"]) for r in decontam.leaks(d, b).collect()}, d, b


QUESTION = "A train leaves Boston at 9 and travels 120 km in 3 hours while Anna Lee waits 20 minutes in Boston; how far does the train of Anna Lee go in 9 hours?"
OTHER = QUESTION.replace("Boston", "Madrid").replace("120", "450").replace("Anna Lee", "Omar Diaz").replace("9", "7").replace("3 hours", "5 hours")


def test_other_values(spark):
    docs = [(1, "Before. " + QUESTION + " After."), (2, "Some text here: " + OTHER), (3, OTHER.replace("Omar Diaz go", "Karl Diaz go")), (4, QUESTION.replace("train", "boat")), (5, QUESTION.upper()), (6, "nothing of the kind at all")]
    got, d, b = run(spark, docs, [(10, QUESTION)])
    assert got == brute(docs, [(10, QUESTION)])
    assert got[1, 10][3] and not got[2, 10][3] and (3, 10) not in got and (6, 10) not in got
    kept = decontam.without_leaks(d, b)
    assert kept.columns == d.columns and {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs} - {d for d, _ in got}


def test_layout(spark):
    text = "the traders Anna Lee and Omar Diaz went by ship from Boston to Madrid where Karl Stone and Ida Berg met them near the old Harbour of Lisbon"
    docs = [(1, text), (2, text.replace(" ", "  ")), (3, text.replace(" ", "\n")), (4, text.replace(" ", "\t")), (5, textwrap.fill(text, 20)), (6, textwrap.fill(text, 30))]
    got, *_ = run(spark, docs, [(10, text)])
    assert len(got) == 6 and len(set(got.values())) == 1 and got[1, 10][3]


TABLE = "12 km 450 kg 7 h 33 19 Rome 8 4 15 Oslo 16 23 42 Bern 99 kg 5 km 71 64 Lima 3 and 58 12 km 9"
DENSE = "we saw that Anna Lee, Omar Diaz, Karl Stone, Ida Berg and Tom Reed met Ole Lund, Eva Ross, Max Wolf and Ana Cruz in Rome, Oslo and Bern with Jan Kos"


def test_copies_without_literal_words(spark):
    """Tables of numbers, other case, a value altered, a middle rewritten: each a leak; the values alone, or few of them, are none."""
    altered = QUESTION.replace("go in 9 hours", "go in 8 hours")  # 9 stands for 9 and for 8, but most windows are equal
    middle = QUESTION.replace("while Anna Lee waits 20 minutes in Boston", "and then it stands for 20 minutes or so")
    docs = [(1, TABLE), (2, "words before, " + TABLE + " and words behind"), (3, DENSE), (4, DENSE.lower()), (5, DENSE.upper()), (6, altered), (7, middle), (8, TABLE[:30]), (9, "12 9 7 4"), (10, QUESTION.lower())]
    items = [(20, TABLE), (21, DENSE), (22, QUESTION)]
    got, *_ = run(spark, docs, items)
    assert got == brute(docs, items)
    assert set(got) == {(1, 20), (2, 20), (3, 21), (4, 21), (5, 21), (6, 22), (7, 22), (10, 22)}
    assert all(got[k][3] for k in [(1, 20), (2, 20), (3, 21), (4, 21), (5, 21), (6, 22), (10, 22)])


def test_stretches_are_judged_one_by_one(spark):
    """A name that stands for two others ends a stretch only where words differ in between."""
    item = "the old miller of Dover sold seven sacks to Anna and then went home to count them; on the next day the tall baker of the town paid Anna for all of it at once"
    two = item.replace("Anna", "Olga").replace("paid Olga", "paid Irma")
    apart = two.replace("count them", "weigh these")
    docs, items = [(1, two), (2, apart)], [(5, item)]
    got, *_ = run(spark, docs, items)
    assert got == brute(docs, items) and (2, 5) in got


def test_sql(spark):
    """The SQL, written on its own, on copies of every kind."""
    import duckdb
    import pandas as pd

    from tabspark.llm.oracles import LEAKS

    item = "the old miller of Dover sold seven sacks to Anna and then went home to count them; on the next day the tall baker of the town paid Anna for all of it at once"
    docs = [(1, TABLE), (2, DENSE.upper()), (3, QUESTION.replace(" ", "\n")), (4, OTHER), (5, item.replace("Anna", "Olga").replace("paid Olga", "paid Irma").replace("count them", "weigh these")), (6, None), (7, "x " + OTHER + " " + TABLE)]
    items = [(20, TABLE), (21, DENSE), (22, QUESTION), (23, item), (24, "short but full of words"), (25, "")]
    con = duckdb.connect()
    for name, rows, key in (("documents", docs, "doc_id"), ("benchmark", items, "item_id")):
        con.register(name, pd.DataFrame(rows, columns=[key, "text"]))
    want = {(r[0], r[1]): tuple(r[2:]) for r in con.execute(LEAKS).fetchall()}
    assert run(spark, docs, items)[0] == want == brute(docs, items)


def test_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r["doc_id"], r["item_id"]): (r["n_windows"], r["coverage"], r["start"], r["verbatim"])
           for r in decontam.op8_decontamination(spark, *(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))).collect()}
    assert got == brute(docs, items)


@pytest.mark.parametrize("limit", [0, 10 ** 9])
def test_odd_inputs(spark, monkeypatch, limit):
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", limit)
    monkeypatch.setattr(decontam, "BROADCAST_IDS", limit)
    items = [(1, "short but full of words"), (2, "12 34 56 78 90 12 34 56 78"), (3, None), (4, ""), (5, "one two three four five six seven eight nine ten eleven twelve thirteen"), (5, "one two three four five six seven eight nine ten eleven twelve thirteen"),
             (None, "one two three four five six seven eight nine")]
    docs = [(1, None), (2, ""), (3, "a b Short, but FULL of words c"), (4, "12 34 56 78 90 12 34 56 78"), (5, "w " * 20_000 + "one two three four five six seven eight nine ten eleven twelve thirteen " * 2), (6, "@ one two three @ four"), (None, "short but full of words")]
    got, d, b = run(spark, docs + docs[2:3], items)
    assert got == brute([x for x in docs if x[0] is not None], [x for x in items if x[0] is not None])
    assert set(got) == {(3, 1), (5, 5), (4, 2)}
    assert run(spark, docs, [])[0] == {} and run(spark, [], items)[0] == {}
    assert sorted(str(r["doc_id"]) for r in decontam.without_leaks(d, b).collect()) == ["1", "2", "6", "None"]
