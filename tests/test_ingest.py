"""Staging: headers, bytes, types, rejects, the gate, loads that replace each other, and arriving quarters."""
import re

import pytest
from pyspark.sql import functions as F

from ledgermill.functions.dates import quarter_window
from ledgermill.schema import SOURCES
from ledgermill.settings import Settings
from ledgermill.sources import staging, tsv

MILL, FORGE = "mill-07", "forge-11"


def line(file, /, **values):
    return "\t".join(str(values.get(f, "")) for f in SOURCES[file].fieldNames()).encode()


def number(tag, value, adsh=MILL, qtrs=0, **more):
    return line("num", adsh=adsh, tag=tag, version="own/1", ddate="20230630", qtrs=qtrs, uom="USD", value=value, **more)


DEFAULT = {
    "sub": [line("sub", adsh=MILL, cik=77, name="Mill & Sons", form="10-Q", period="20230630", filed="20230801"),
            line("sub", adsh=FORGE, cik=78, name="Forge", form="10-K", period="20230630", filed="20230802")],
    "num": [number("Timber", "12.5"), number("Timber", "-3"), number("Rent", "7e2", qtrs=2, segments="Site=North;"),
            number("Iron", "", adsh=FORGE), number("Iron", "41", adsh=FORGE, footnote="it's \"odd\", isn't it")],
    "tag": [line("tag", tag=t, version="own/1", custom=0, datatype="monetary", iord="I") for t in ("Timber", "Rent", "Iron")],
    "pre": [line("pre", adsh=MILL, report=2, line=9, stmt="BS", tag="Timber", version="own/1")],
}


def deliver(folder, end=b"\n", headers=None, **files):
    """A quarter as text files; ``files`` replaces lines, ``headers`` replaces first lines."""
    folder.mkdir(parents=True)
    for name in SOURCES:
        first = (headers or {}).get(name, tsv.header_of(name).encode())
        lines = [x for x in [first, *files.get(name, DEFAULT[name])] if x is not None]
        (folder / f"{name}.txt").write_bytes(b"".join(x + end for x in lines))
    return str(folder)


@pytest.mark.parametrize("end", [b"\n", b"\r\n"])
def test_values_survive(spark, tmp_path, end):
    root = str(tmp_path / "stage")
    done = staging.load_quarter(spark, deliver(tmp_path / "2023q2", end), "2023q2", root)
    assert {n: (a.lines, a.parsed, a.rejected) for n, a in done.items()} == {
        n: (len(x), len(x), 0) for n, x in DEFAULT.items()}
    rows = {(r["tag"], r["value"]): r for r in staging.read_staged(spark, root, "num").collect()}
    assert set(rows) == {("Timber", 12.5), ("Timber", -3.0), ("Rent", 700.0), ("Iron", None), ("Iron", 41.0)}
    assert rows["Rent", 700.0]["segments"] == "Site=North;" and rows["Rent", 700.0]["qtrs"] == 2
    assert rows["Iron", 41.0]["footnote"] == "it's \"odd\", isn't it" and rows["Iron", None]["footnote"] is None
    assert {r["dataset_quarter"] for r in rows.values()} == {"2023q2"}


def test_bytes_that_are_no_text(spark, tmp_path):
    sub = [line("sub", adsh=MILL, cik=77, name="Mill").replace(b"Mill", b"M\xfell \xc3\xa9\xc3")]
    staging.load_quarter(spark, deliver(tmp_path / "2023q2", sub=sub), "2023q2", str(tmp_path / "stage"))
    assert staging.read_staged(spark, str(tmp_path / "stage"), "sub").first()["name"] == "M�ll é�"


def test_headers(spark, tmp_path):
    swapped = b"\t".join(reversed(tsv.header_of("pre").encode().split(b"\t")))
    for k, headers in enumerate(({"pre": swapped}, {"num": b"adsh\ttag"}, {"sub": None})):
        with pytest.raises(tsv.HeaderMismatch):
            staging.load_quarter(spark, deliver(tmp_path / f"in{k}", headers=headers), "2023q2", str(tmp_path / "stage"))
    assert staging.complete_quarters(spark, str(tmp_path / "stage")) == []


def test_every_file_of_a_folder_has_a_header(spark, tmp_path):
    source = tmp_path / "2023q2"
    deliver(source)
    whole = (source / "num.txt").read_bytes()
    (source / "num.txt").unlink()
    (source / "num.txt").mkdir()
    (source / "num.txt" / "a.txt").write_bytes(whole)
    (source / "num.txt" / "b.txt").write_bytes(number("Late", 5) + b"\n")
    with pytest.raises(tsv.HeaderMismatch):
        staging.load_quarter(spark, str(source), "2023q2", str(tmp_path / "stage"))
    assert staging.complete_quarters(spark, str(tmp_path / "stage")) == []


def test_rejects_keep_their_text_and_count(spark, tmp_path):
    num = [*DEFAULT["num"], number("Coal", "seven"), number("Coal", 1, qtrs="1.5"), number("Coal", 2) + b"\tx", b"",
           b"short\tCoal"]
    source, root = deliver(tmp_path / "2023q2", num=num), str(tmp_path / "stage")
    with pytest.raises(tsv.RejectRateExceeded):
        staging.load_quarter(spark, source, "2023q2", root)
    assert staging.read_staged(spark, root, "num").count() == 0 and staging.rejects(spark, root, "num").count() == 0
    found = staging.load_quarter(spark, source, "2023q2", root, Settings(max_reject_rate=0.5))["num"]
    assert (found.lines, found.parsed, found.rejected, found.agrees) == (9, 6, 3, True)
    kept = {r[tsv.RAW_LINE] for r in staging.rejects(spark, root, "num").collect()}
    assert kept == {x.decode() for x in num[5:8]}
    short = staging.read_staged(spark, root, "num").where("adsh = 'short'").first()
    assert short["tag"] == "Coal" and short["value"] is None and short["uom"] is None


def test_a_difference_in_the_count_is_told(spark, tmp_path, monkeypatch):
    """The two counts are independent: a parser that loses lines is noticed."""
    plain = tsv.parse
    monkeypatch.setattr(tsv, "parse", lambda lines, *a: plain(lines.where("value NOT LIKE '%Rent%'"), *a))
    with pytest.warns(UserWarning, match="num: 4 lines parsed and 0 rejected, 5 in the text"):
        staging.load_quarter(spark, deliver(tmp_path / "2023q2"), "2023q2", str(tmp_path / "stage"))


def tags_of(spark, root):
    return sorted(r["tag"] for r in staging.read_staged(spark, root, "num").collect())


def test_loading_twice_and_by_force(spark, tmp_path):
    root, source = str(tmp_path / "stage"), str(tmp_path / "in")
    deliver(tmp_path / "in" / "2023q2")
    deliver(tmp_path / "in" / "2023q3", num=[number("Later", 1)])
    assert staging.load_quarters(spark, source, ["2023q2", "2023q3"], root) == ["2023q2", "2023q3"]
    assert staging.load_quarters(spark, source, ["2023q2", "2023q3"], root) == []
    assert staging.load_quarter(spark, f"{source}/2023q2", "2023q2", root)["num"].parsed == 5
    assert staging.load_quarters(spark, source, ["2023q3"], root, force=True) == ["2023q3"]
    assert tags_of(spark, root) == ["Iron", "Iron", "Later", "Rent", "Timber", "Timber"]
    assert staging.read_staged(spark, root, "num", ["2023q3", "1999q1"]).count() == 1
    assert staging.ingest_log(spark, root).count() == 8
    assert staging.superseded(spark, root).count() == 4 and staging.vacuum(spark, root) == 4
    assert len(tags_of(spark, root)) == 6


def test_a_crash_leaves_the_former_load(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "stage")
    staging.load_quarter(spark, deliver(tmp_path / "one"), "2023q2", root)
    before, plain = tags_of(spark, root), staging.write_version

    def crashing(lines, root, name, *more):
        if name == "tag":
            raise RuntimeError("lost")
        return plain(lines, root, name, *more)

    second = deliver(tmp_path / "two", num=[number("New", 1)], sub=DEFAULT["sub"][:1])
    monkeypatch.setattr(staging, "write_version", crashing)
    with pytest.raises(RuntimeError, match="lost"):
        staging.load_quarter(spark, second, "2023q2", root, force=True)
    assert tags_of(spark, root) == before and staging.read_staged(spark, root, "sub").count() == 2
    assert staging.complete_quarters(spark, root) == ["2023q2"]
    monkeypatch.setattr(staging, "write_version", plain)
    staging.load_quarter(spark, second, "2023q2", root, force=True)
    assert tags_of(spark, root) == ["New"] and staging.read_staged(spark, root, "sub").count() == 1
    assert staging.vacuum(spark, root) == 6  # four files of the first load, two of the crashed one


def test_a_failed_gate_leaves_the_former_load(spark, tmp_path):
    root = str(tmp_path / "stage")
    staging.load_quarter(spark, deliver(tmp_path / "one"), "2023q2", root)
    broken = deliver(tmp_path / "two", pre=[line("pre", adsh=MILL, report="x")], num=[number("New", 1)])
    with pytest.raises(tsv.RejectRateExceeded):
        staging.load_quarter(spark, broken, "2023q2", root, force=True)
    assert "New" not in tags_of(spark, root) and staging.complete_quarters(spark, root) == ["2023q2"]
    assert {r["status"] for r in staging.ingest_log(spark, root).collect()} == {"failed"}


def test_quarters_with_differing_columns(spark, tmp_path):
    from pyspark.sql import types as T
    older = T.StructType([f for f in SOURCES["num"].fields if f.name not in ("coreg", "footnote")])
    root = str(tmp_path / "stage")
    early = ["\t".join(["a1", "Old", "own/1", "20220630", "0", "USD", "Site=South;", "3"]).encode()]
    staging.load_quarter(spark, deliver(tmp_path / "a", headers={"num": tsv.header_of("num", older).encode()}, num=early),
                         "2022q2", root, declared={"num": older})
    staging.load_quarter(spark, deliver(tmp_path / "b"), "2023q2", root)
    rows = staging.read_staged(spark, root, "num")
    assert rows.columns == [*SOURCES["num"].fieldNames(), "dataset_quarter"] and rows.count() == 6
    old = rows.where("dataset_quarter = '2022q2'").first()
    assert (old["segments"], old["footnote"], old["value"]) == ("Site=South;", None, 3.0)
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = rows.where("dataset_quarter = '2022q2'")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = re.search(r"PartitionFilters: \[(.*?)\], ", plan)[1]
    assert "dataset_quarter" in filters and "2022q2" in filters, plan


def test_quarter_window():
    assert quarter_window("2021q1", 2) == ["2020q4", "2021q1"]
    assert len(quarter_window("2021q1", 9)) == 9 and quarter_window("2021q1", 9)[0] == "2019q1"


def test_arriving_quarters(spark, tmp_path):
    from ledgermill.streaming.arrival import staged_numbers, watch_numbers
    source, root, marks = str(tmp_path / "in"), str(tmp_path / "stage"), str(tmp_path / "marks")
    deliver(tmp_path / "in" / "2023q2")
    deliver(tmp_path / "in" / "2023q3", num=[number("Odd", "x"), number("Fine", 1)])
    watch_numbers(spark, source, root, marks, Settings(max_reject_rate=0.1)).awaitTermination()
    deliver(tmp_path / "in" / "2023q4", num=[number("Next", 1), number("Next", 2)])
    watch_numbers(spark, source, root, marks, Settings(max_reject_rate=0.1)).awaitTermination()
    rows = staged_numbers(spark, root).groupBy("dataset_quarter").count().collect()
    assert {r["dataset_quarter"]: r["count"] for r in rows} == {"2023q2": 5, "2023q4": 2}
    log = {r["dataset_quarter"]: r for r in staging.ingest_log(spark, root).collect()}
    assert log["2023q3"]["status"] == "failed" and log["2023q3"]["rejects"] == 1 and log["2023q4"]["rows"] == 2
    # the batch loader finds the other files of the quarter missing, and takes the whole quarter
    assert staging.complete_quarters(spark, root) == []
    staging.load_quarter(spark, f"{source}/2023q2", "2023q2", root)
    assert staging.complete_quarters(spark, root) == ["2023q2"]


def test_a_field_is_cast_once(spark, tmp_path):
    """A cast that fails raises an error inside, which takes longer than the rest of the line."""
    path = tmp_path / "num.txt"
    path.write_bytes(tsv.header_of("num").encode() + b"\n")
    plan = tsv.scan(spark, str(path), "num")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("try_cast") == 2, plan  # qtrs and value


def test_numbers_and_what_only_looks_like_them(spark):
    """The guard in front of a cast takes nothing away that the cast accepts."""
    texts = ["?", "7", " 7\t", "+7", "-7", "7.5", ".5", "5.", "1e3", "x7", "7x", "0x10", "7d", "NaN", "nan", "Infinity", "-inf", "INF",
             "\x017", " 7", "٧", "7 ", "99999999999", "--7", "7-", "7,5", "1_0", " ", ".", "+", "e", "N"]
    lines = spark.createDataFrame([("\u0001".join(map(str, range(9))) + str(k) + "\t" * 4 + t + "\t" * 4 + t, t)
                                   for k, t in enumerate(texts)], "value string, given string")
    kept = [t for t in texts if "\t" not in t]
    rows = (tsv.parse(lines.where(~F.contains("given", F.lit("\t"))), "num")
            .withColumns({"whole": F.expr("try_cast(given AS int)"), "dbl": F.expr("try_cast(given AS double)")}).collect())
    assert len(rows) == len(kept)
    for r in rows:
        bad = r["whole"] is None or r["dbl"] is None
        assert (r["qtrs"], str(r["value"]), r["rejected"]) == (r["whole"], str(r["dbl"]), bad), r["given"]


def test_carriage_returns(spark):
    header = tsv.header_of("num")
    lines = spark.createDataFrame([(x,) for x in (header, header + "\r", "", "\r", "a\tT\r", "a\tT\rU", "a\tT")], "value string")
    assert [r["tag"] for r in tsv.parse(lines, "num").collect()] == ["T", "T\rU", "T"]
