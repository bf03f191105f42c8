"""A tiny shop with one of every awkward case, as raw text rows and CSV files."""

from __future__ import annotations

import csv
from pathlib import Path

from shopmart.sources.contracts import RAW_COLUMNS

RAW: dict[str, list[tuple]] = {
    "customers": [
        ("c1", "p1", "01001", "São Paulo - SP", " sp "),
        ("c2", "p1", "20000", "rio de janeiro, brasil", "RJ"),
        ("c3", "p2", "01001", "sao paulo / sao paulo", "SP"),
        ("c4", "p3", "30000", " / ", "MG"),
        ("c5", "p4", "30000", "Auriflama/SP", "MG"),
        ("c6", "p5", "01001", "Lages", "SP"),
    ],
    "orders": [
        # delivered exactly on the promised day: on time
        ("o1", "c1", "delivered", "2017-01-05 10:00:00", "2017-01-05 11:00:00",
         "2017-01-06 08:00:00", "2017-01-20 18:00:00", "2017-01-20 00:00:00"),
        # same person, later, in another state, one day late
        ("o2", "c2", "delivered", "2017-03-10 09:00:00", "2017-03-10 09:30:00",
         "2017-03-12 08:00:00", "2017-03-26 00:00:01", "2017-03-25 00:00:00"),
        # cancelled, yet delivered late
        ("o3", "c3", "canceled", "2017-02-01 00:00:00", "2017-02-01 00:10:00",
         "2017-02-02 00:00:00", "2017-03-01 00:00:00", "2017-02-20 00:00:00"),
        # delivered without a delivery date
        ("o4", "c4", "delivered", "2017-02-15 00:00:00", None,
         "2017-02-16 00:00:00", None, "2017-03-01 00:00:00"),
        # shipped, no items and no payment
        ("o5", "c5", "shipped", "2017-11-24 00:00:00", "2017-11-24 01:00:00",
         None, None, "2017-12-10 00:00:00"),
        # handed to the carrier before it was placed
        ("o6", "c6", "delivered", "2017-11-24 12:00:00", "2017-11-24 12:10:00",
         "2017-11-23 12:00:00", "2017-11-28 12:00:00", "2017-12-20 00:00:00"),
    ],
    "order_items": [
        ("o1", "1", "x1", "s1", "2017-01-10 00:00:00", "100.00", "10.00"),
        ("o1", "2", "x2", "s2", "2017-01-10 00:00:00", "50.50", "5.25"),
        ("o2", "1", "x1", "s1", "2017-03-15 00:00:00", "80.00", "8.00"),
        ("o3", "1", "x3", "s1", "2017-02-05 00:00:00", "30.00", "3.00"),
        ("o4", "1", "x4", "s2", "2017-02-20 00:00:00", "20.00", "2.00"),
        ("o6", "1", "x2", "s2", "2017-11-26 00:00:00", "40.00", "4.00"),
    ],
    "order_payments": [
        ("o1", "2", "voucher", "1", "82.875"),  # rounds to 82.88
        ("o1", "1", "credit_card", "3", "82.88"),  # equal value, earlier: the main one
        ("o2", "1", "boleto", "1", "88.00"),
        ("o3", "1", "credit_card", "2", "31.00"),  # two short: underpaid
        ("o4", "1", "credit_card", "10", "25.00"),  # interest
        ("o6", "1", "debit_card", "1", "44.00"),
    ],
    "order_reviews": [
        ("r1", "o1", "5", " great ", 'He said "fine",\nthen left', "2017-01-21 00:00:00",
         "2017-01-22 00:00:00"),
        # two answers at the same moment, one survey date unknown: unknown is latest
        ("r2", "o2", "1", "", "late", "2017-03-27 00:00:00", "2017-03-28 00:00:00"),
        ("r3", "o2", "2", None, "  ", None, "2017-03-28 00:00:00"),
        # one review id for two orders
        ("r4", "o3", "2", None, None, "2017-03-02 00:00:00", "2017-03-03 00:00:00"),
        ("r4", "o4", "4", None, None, "2017-03-02 00:00:00", "2017-03-03 00:00:00"),
    ],
    "products": [
        ("x1", "beleza", "10", "100", "1", "500", "10", "20", "30"),
        ("x2", None, "12", "120", None, None, None, None, None),
        ("x3", "pc_gamer", "9", "90", "2", "900", "1", "2", "3"),
        ("x4", "cool_stuff", "8", "80", "2", "100", "2", "2", "2"),
    ],
    "sellers": [
        ("s1", "01001", "sao paulo", "SP"),
        ("s2", "30000", "belo horizonte", "MG"),
    ],
    "geolocation": [
        ("01001", "-23.5", "-46.6", "são paulo", "SP"),
        ("01001", "-23.7", "-46.4", "sao paulo", "SP"),
        ("01001", "45.0", "-46.4", "sao paulo", "SP"),  # outside
        ("20000", "5.5", "-34.5", "rio", "RJ"),  # on the edge
        ("30000", None, "-43.9", "bh", "MG"),
    ],
    "product_category_name_translation": [
        ("beleza", "health_beauty"),
        ("cool_stuff", "cool_stuff"),
    ],
}


def raw_frames(spark, **changed):
    tables = {**RAW, **changed}
    return {
        name: spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS[name]))
        for name, rows in tables.items()
    }


def write_landing(folder: Path, file_name="{table}.csv", **changed) -> Path:
    folder.mkdir(parents=True, exist_ok=True)
    for table, rows in {**RAW, **changed}.items():
        path = folder / file_name.format(table=table)
        # One of the files carries a byte-order mark.
        encoding = "utf-8-sig" if table == "product_category_name_translation" else "utf-8"
        with path.open("w", encoding=encoding, newline="") as out:
            writer = csv.writer(out, lineterminator="\n")
            writer.writerow(RAW_COLUMNS[table])
            writer.writerows(rows)
    return folder
