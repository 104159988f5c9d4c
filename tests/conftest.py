import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from clickloom.schema import BRONZE_COLUMNS, RAW_COLUMNS  # noqa: E402

BRONZE_SCHEMA = ", ".join(f"{name} string" for name in BRONZE_COLUMNS)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def bronze(spark):
    """Bronze rows from dicts; columns left out get a plain valid value."""
    plain = {
        "event_time": "2021-03-14 08:30:15 UTC",
        "event_type": "view",
        "product_id": "5021",
        "category_id": "77",
        "category_code": "garden.tools.rake",
        "brand": "fernwood",
        "price": "42.50",
        "user_id": "9001",
        "user_session": "visit-k",
        "_corrupt_record": None,
        "source_file": "spring.csv",
    }

    def build(*rows):
        filled = [{**plain, **row} for row in rows]
        return spark.createDataFrame(
            [tuple(row[name] for name in BRONZE_COLUMNS) for row in filled], BRONZE_SCHEMA
        )

    return build


@pytest.fixture
def csv_file(tmp_path):
    """Write an event file from lists of nine values or from whole lines."""

    def write(name, rows, header=",".join(RAW_COLUMNS), encoding="utf-8"):
        lines = [header, *[row if isinstance(row, str) else ",".join(row) for row in rows]]
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n", encoding=encoding)
        return str(path)

    return write


def line(time, kind, product, user, session, **other):
    """A whole line of a shop that sells lamps, desks and seeds."""
    code, category, brand, price = {
        "lamp": ("home.light.lamp", "31", "lumo", "19.90"),
        "desk": ("home.office.desk", "32", "", "250.00"),
        "seed": ("", "40", "fernwood", "0.00"),
        "shed": ("garden.shed", "", "", "-3.25"),
    }[product]
    number = {"lamp": "601", "desk": "602", "seed": "603", "shed": "604"}[product]
    values = {"time": f"{time} UTC", "kind": kind, "number": number, "category": category,
              "code": code, "brand": brand, "price": price, "user": user, "session": session,
              **other}
    return [*values.values()]


@pytest.fixture
def shop_files():
    """Lines of two files. Two lines of the first come again: one in the same file, one in the
    second. Session ``s-late`` goes on over a month's end. Of the 15 lines three are rejected (a bad
    day, an unknown type, an unreadable product)."""
    lamp = line("2021-04-29 20:15:00", "view", "lamp", "1", "s-lamp")
    bought = line("2021-04-29 20:40:00", "purchase", "lamp", "1", "s-lamp")
    first = [
        lamp,
        line("2021-04-29 20:20:00", "cart", "lamp", "1", "s-lamp"),
        bought,
        list(lamp),
        line("2021-04-30 06:00:00", "view", "seed", "2", "s-seed"),
        line("2021-04-30 06:05:00", "purchase", "seed", "2", "s-seed"),
        line("2021-04-30 23:58:00", "view", "desk", "3", "s-late"),
        line("2021-04-31 10:00:00", "view", "desk", "3", "s-bad-day"),
    ]
    second = [
        list(bought),
        line("2021-05-01 00:01:00", "cart", "desk", "3", "s-late"),
        line("2021-05-01 00:09:00", "purchase", "desk", "3", "s-late"),
        line("2021-05-02 11:00:00", "remove_from_cart", "shed", "4", ""),
        line("2021-05-02 11:30:00", "purchase", "shed", "4", ""),
        line("2021-05-02 12:00:00", "wishlist", "desk", "5", "s-wish"),
        line("2021-05-02 12:10:00", "view", "desk", "5", "s-wish", number="60x"),
    ]
    return {"april.csv": first, "may.csv": second}
