import hashlib

import pytest
from shop import RAW, write_landing

from shopmart.sources import contracts, landing
from shopmart.sources.contracts import RAW_COLUMNS, SourceFiles
from shopmart.sources.export import export_csv, read_exported
from shopmart.sources.publish import Publisher


def test_two_tables_cannot_share_a_file():
    clash = SourceFiles("shop.csv", (("sellers", "s.csv"), ("orders", "o.csv")))
    with pytest.raises(ValueError, match="shop.csv stands for customers, geolocation, order_items"):
        clash.all()
    assert sorted(SourceFiles().all()) == sorted(RAW_COLUMNS)


def test_file_names_follow_a_pattern_with_exceptions():
    files = SourceFiles("shop_{table}_dataset.csv", (("sellers", "s.csv"),))
    assert files.file_name("orders") == "shop_orders_dataset.csv"
    assert files.file_name("sellers") == "s.csv"


def test_header_loses_byte_order_mark_and_blanks(spark, tmp_path):
    path = tmp_path / "bom.csv"
    path.write_bytes("﻿order_id, city \na,b\n".encode())
    assert landing.read_header(spark, str(path)) == ["order_id", "city"]


@pytest.mark.parametrize(
    ("header", "faults"),
    [
        ([], ["is empty"]),
        (["seller_id", "Seller City"], ["has the unsafe column name 'Seller City'"]),
        (["1st", "x-y"], ["has the unsafe column name '1st'", "has the unsafe column name 'x-y'"]),
        (["state", "city", "state"], ["repeats the column state"]),
        (["_private", "price2"], []),
    ],
)
def test_header_faults(header, faults):
    assert contracts.header_faults(header) == faults


def test_difference_tells_missing_extra_and_moved_columns():
    assert contracts.difference(["a", "c"], ["a", "b"], ordered=True) == [
        "lacks the column b",
        "has the extra column c",
    ]
    assert contracts.difference(["b", "a"], ["a", "b"], ordered=False) == []
    assert len(contracts.difference(["b", "a"], ["a", "b"], ordered=True)) == 1


def test_faults_of_all_files_are_told_at_once(spark, tmp_path):
    folder = write_landing(tmp_path / "in")
    for name in ("sellers", "orders"):
        lines = (folder / f"{name}.csv").read_text().splitlines(keepends=True)
        (folder / f"{name}.csv").write_text("".join(["Zip Code," + lines[0], *lines[1:]]))
    with pytest.raises(contracts.HeaderError) as caught:
        landing.load_raw(spark, str(folder), Publisher(spark, str(tmp_path / "raw")))
    assert "sellers.csv has the unsafe" in str(caught.value)
    assert "orders.csv has the unsafe" in str(caught.value)


def test_load_names_the_empty_file(spark, tmp_path):
    folder = write_landing(tmp_path / "in")
    (folder / "sellers.csv").write_text("")
    with pytest.raises(ValueError, match="sellers.csv is empty"):
        landing.check_source_files(spark, str(folder))


def test_missing_tables_are_told_beside_folders_of_parts(spark, tmp_path):
    """Tables given as folders of parts count as found; other files and hidden ones do not."""
    for part in ("orders.csv/part-0.csv", "orders.csv/part-1.csv", "products.csv/part-0.csv"):
        (tmp_path / part).parent.mkdir(exist_ok=True)
        (tmp_path / part).write_text("x\n")
    (tmp_path / "_sellers.csv").write_text("x\n")
    (tmp_path / "notes.txt").write_text("x\n")
    with pytest.raises(FileNotFoundError) as caught:
        landing.check_source_files(spark, str(tmp_path))
    told = str(caught.value).rsplit(": ", 1)[1].split(", ")
    assert told == [f"{t}.csv" for t in RAW_COLUMNS if t not in ("orders", "products")]


def test_load_keeps_text_line_breaks_quotes_and_leading_zeros(spark, tmp_path):
    folder = write_landing(tmp_path / "in")
    raw = landing.load_raw(spark, str(folder), Publisher(spark, str(tmp_path / "raw")))
    for table, rows in RAW.items():
        assert raw[table].count() == len(rows), table
        assert set(dict(raw[table].dtypes).values()) == {"string"}
    messages = {r.review_comment_message for r in raw["order_reviews"].collect()}
    assert 'He said "fine",\nthen left' in messages
    assert {r.customer_zip_code_prefix for r in raw["customers"].collect()} >= {"01001"}


def test_quoted_empty_is_text_and_unquoted_empty_is_null(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b\n"",1\n,2\n')
    rows = landing.read_raw(spark, [str(path)], ["a", "b"]).orderBy("b").collect()
    assert [r.a for r in rows] == ["", None]


@pytest.mark.parametrize("row", ["1,2,3", "1"])
def test_ragged_rows_fail(spark, tmp_path, row):
    path = tmp_path / "x.csv"
    path.write_text(f"a,b\n1,2\n{row}\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        landing.read_raw(spark, [str(path)], ["a", "b"]).collect()


def test_reload_replaces_tables_and_audits_every_file(spark, tmp_path):
    folder = write_landing(tmp_path / "in")
    publisher = Publisher(spark, str(tmp_path / "raw"))
    first = {t: df.count() for t, df in landing.load_raw(spark, str(folder), publisher).items()}
    again = {t: df.count() for t, df in landing.load_raw(spark, str(folder), publisher).items()}
    assert first == again
    audit = publisher.read("load_audit").collect()
    assert len(audit) == 2 * len(RAW_COLUMNS)
    for row in audit:
        content = (folder / row.file_name).read_bytes()
        assert row.sha256 == hashlib.sha256(content).hexdigest()
        assert row.row_count == len(RAW[row.table_name])


def test_failed_load_leaves_the_previous_one(spark, tmp_path):
    folder = write_landing(tmp_path / "in")
    publisher = Publisher(spark, str(tmp_path / "raw"))
    landing.load_raw(spark, str(folder), publisher)
    with (folder / "sellers.csv").open("a") as out:
        out.write("s9,1\n")
    orders = folder / "orders.csv"
    orders.write_text(orders.read_text().splitlines()[0] + "\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        landing.load_raw(spark, str(folder), publisher)
    assert publisher.read("orders").count() == len(RAW["orders"])
    assert publisher.read("load_audit").count() == len(RAW_COLUMNS)


def test_changed_header_stops_the_load(spark, tmp_path):
    folder = write_landing(tmp_path / "in")
    publisher = Publisher(spark, str(tmp_path / "raw"))
    landing.load_raw(spark, str(folder), publisher)
    path = folder / "sellers.csv"
    path.write_text(path.read_text().replace("seller_city,seller_state", "seller_state,seller_city"))
    with pytest.raises(contracts.HeaderError, match="sellers.csv has its columns in another order"):
        landing.load_raw(spark, str(folder), publisher)


def test_row_counts(spark, frame):
    counted = landing.row_counts(
        {"a": frame([(1,), (2,)], "x int"), "b": frame([], "x int")}
    ).collect()
    assert {(r.table_name, r.row_count) for r in counted} == {("a", 2), ("b", 0)}


def test_export_writes_booleans_nulls_and_quotes(spark, frame, tmp_path):
    df = frame([(1, True, None, 'say "hi"'), (2, False, "x", "a,b")], "a int, b boolean, c string, d string")
    counts = export_csv({"t": df.coalesce(1)}, str(tmp_path))
    assert counts == {"t": 2}
    (part,) = (tmp_path / "t").glob("part-*.csv")
    assert part.read_text().splitlines() == [
        "a,b,c,d",
        '1,true,,"say ""hi"""',
        '2,false,x,"a,b"',
    ]


def test_a_table_may_be_a_folder_of_files(spark, tmp_path):
    folder = write_landing(tmp_path / "in")
    orders = (folder / "orders.csv").read_text().splitlines()
    (folder / "orders.csv").unlink()
    (folder / "orders.csv").mkdir()
    for n, part in enumerate((orders[1:3], orders[3:])):
        text = "\n".join([orders[0], *part]) + "\n"
        (folder / "orders.csv" / f"part-{n}.csv").write_text(text)
    publisher = Publisher(spark, str(tmp_path / "raw"))
    raw = landing.load_raw(spark, str(folder), publisher)
    assert raw["orders"].count() == len(RAW["orders"])
    audit = {r.file_name: r.row_count for r in publisher.read("load_audit").collect()}
    assert audit["part-0.csv"] == 2 and audit["part-1.csv"] == len(RAW["orders"]) - 2
    assert len(audit) == len(RAW_COLUMNS) + 1


def test_line_breaks_in_fields_of_any_file(spark, tmp_path):
    """One of two files of a table holds breaks, quotes and a comma in a field, another table CRLF lines."""
    folder = write_landing(tmp_path / "in")
    customers = (folder / "customers.csv").read_text()
    header = customers.splitlines()[0]
    (folder / "customers.csv").unlink()
    (folder / "customers.csv").mkdir()
    (folder / "customers.csv" / "plain.csv").write_text(customers)
    odd = header + '\nc9,p9,00001,"Rio ""de""\nJaneiro, RJ\r\nBrasil",RJ\nc10,p10,00002,"a""",SP\n'
    (folder / "customers.csv" / "breaks.csv").write_bytes(odd.encode())
    sellers = (folder / "sellers.csv").read_bytes()
    (folder / "sellers.csv").write_bytes(sellers.replace(b"\n", b"\r\n"))
    publisher = Publisher(spark, str(tmp_path / "raw"))
    raw = landing.load_raw(spark, str(folder), publisher)
    cities = {r.customer_id: r.customer_city for r in raw["customers"].collect()}
    assert len(cities) == len(RAW["customers"]) + 2
    assert cities["c9"].replace("\r", "") == 'Rio "de"\nJaneiro, RJ\nBrasil' and cities["c10"] == 'a"'
    assert {tuple(r) for r in raw["sellers"].collect()} == set(RAW["sellers"])
    audit = {r.file_name: r.row_count for r in publisher.read("load_audit").collect()}
    assert audit["plain.csv"] == len(RAW["customers"]) and audit["breaks.csv"] == 2


@pytest.mark.parametrize("name", ["with blanks", "br[a]ck{e}t*s?", "plus+per%20cent", "é中#"])
def test_folders_of_any_name(spark, tmp_path, name):
    import os

    folder = write_landing(tmp_path / "x")
    os.rename(folder, tmp_path / name)
    publisher = Publisher(spark, str(tmp_path / "raw"))
    where = landing.as_pattern(str(tmp_path / name))
    raw = landing.load_raw(spark, where, publisher)
    assert {t: df.count() for t, df in raw.items()} == {t: len(rows) for t, rows in RAW.items()}
    audit = {r.table_name: (r.row_count, r.sha256) for r in publisher.read("load_audit").collect()}
    for table, rows in RAW.items():
        content = (tmp_path / name / f"{table}.csv").read_bytes()
        assert audit[table] == (len(rows), hashlib.sha256(content).hexdigest())


def test_files_without_rows_are_audited_with_none(spark, tmp_path):
    folder = write_landing(tmp_path / "in", sellers=[])
    publisher = Publisher(spark, str(tmp_path / "raw"))
    raw = landing.load_raw(spark, str(folder), publisher)
    assert raw["sellers"].count() == 0 and raw["sellers"].columns == list(RAW_COLUMNS["sellers"])
    audit = {r.table_name: r.row_count for r in publisher.read("load_audit").collect()}
    assert audit["sellers"] == 0 and len(audit) == len(RAW_COLUMNS)
    landing.load_raw(spark, str(write_landing(tmp_path / "again")), publisher)
    assert publisher.read("sellers").count() == len(RAW["sellers"])


def test_inspection_is_the_same_whatever_the_chunks(spark):
    text = b'\xef\xbb\xbfa,"b\n1"\r\n1,"x ""y"" z"\n2,"p\nq"\n'
    wanted = (hashlib.sha256(text).hexdigest(), ["a", "b\n1"], True)
    for size in (1, 2, 3, 7, 1000):
        inspection = landing._Inspection()
        for at in range(0, len(text), size):
            inspection.add(text[at : at + size])
        assert inspection.result() == wanted
    plain = landing._Inspection()
    plain.add(b'a,b\n"1","2 ""x"""\n')
    assert plain.result()[1:] == (["a", "b"], False)


def test_object_store_paths_are_opened_by_their_store(monkeypatch):
    asked = []

    class Store:
        def open_input_stream(self, path):
            asked.append(path)

    def from_uri(uri):
        asked.append(uri)
        return Store(), "inner"

    class Systems:
        FileSystem = type("FileSystem", (), {"from_uri": staticmethod(from_uri)})
        LocalFileSystem = Store

    monkeypatch.setattr(landing, "pafs", Systems)
    landing._open("s3a://bucket/a folder/x.csv")
    landing._open("file:/tmp/a b.csv")
    landing._open("/tmp/c.csv")
    assert asked == ["s3://bucket/a%20folder/x.csv", "inner", "/tmp/a b.csv", "/tmp/c.csv"]


def test_exported_files_are_read_back_as_they_were(spark, frame, tmp_path):
    rows = [
        (1, True, None, 'say "hi"\nand go', " padded ", "1.50", "2018-01-02 03:04:05.000006"),
        (2, None, "", "a,b", "\\", None, None),
    ]
    df = frame(rows, "a int, b boolean, c string, d string, e string, f string, g string").selectExpr(
        "a", "b", "c", "d", "e", "cast(f as decimal(12,2)) f", "cast(g as timestamp_ntz) g", "date'2018-01-02' h", "0.1D i"
    )
    export_csv({"t": df}, str(tmp_path))
    back = read_exported(spark, str(tmp_path), "t", df.schema)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(back.collect()) == sorted(df.collect())


def test_compressed_files_are_read_back_as_they_were(spark, frame, tmp_path):
    df = frame([(1, 'a "quoted"\nline', None), (2, "", True)], "a int, b string, c boolean")
    assert export_csv({"t": df.coalesce(1)}, str(tmp_path), compression="gzip") == {"t": 2}
    assert len([*(tmp_path / "t").glob("part-*.csv.gz")]) == 1
    assert sorted(read_exported(spark, str(tmp_path), "t", df.schema).collect()) == sorted(df.collect())
