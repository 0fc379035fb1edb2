"""Small frames for hand-computed cases."""

from datetime import date, timedelta


def day(n: int, start: date = date(2020, 1, 1)) -> date:
    return start + timedelta(days=n)


def one_cell(spark, column, values, start=date(2020, 1, 1), kind="double"):
    """One cell with consecutive days."""
    rows = [(day(i, start), 0, 0, 0.0, 0.0, v) for i, v in enumerate(values)]
    return spark.createDataFrame(
        rows, f"date date, lat_i int, lon_i int, lat double, lon double, {column} {kind}")


def cube(spark, rows):
    """(day, lat_i, lon_i, value) rows; coordinates equal positions."""
    return spark.createDataFrame(
        [(day(d), y, x, float(y), float(x), v) for d, y, x, v in rows],
        "date date, lat_i int, lon_i int, lat double, lon double, value double")


def column(df, name, *order):
    return [r[name] for r in df.orderBy(*(order or ("date",))).collect()]
