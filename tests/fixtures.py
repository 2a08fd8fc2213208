"""A small raw listing table with one defect per row (all strings, like a
header CSV read without schema inference)."""
from lodgeframe.columns import COLS

RAW_COLUMNS = COLS.raw_order


def row(id_, name="Sunny flat", host_id="10", host_name="Ana", zone="Harbour",
        subzone="Docks", lat="40.71", lon="-74.00", kind="Entire home/apt", price="120",
        nights="2", reviews="8", last_review="2019-05-01", rpm="0.5", hosted="1",
        avail="200"):
    return (id_, name, host_id, host_name, zone, subzone, lat, lon, kind, price, nights,
            reviews, last_review, rpm, hosted, avail)


DEFECTS = [
    row("1"),                                                   # clean, kept
    row("2", reviews="0", last_review=None, rpm=None),          # no reviews: kept, filled
    row("3", price="0"),                                        # price 0: dropped
    row("1"),                                                   # exact duplicate of 1
    row("5", nights="400"),                                     # nights > 365: dropped
    row("6", name=None, host_name=None),                        # names missing: kept
    row("7", price="-15"),                                      # negative price: dropped
]


def raw_df(spark, rows=DEFECTS):
    schema = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    return spark.createDataFrame(rows, schema)
