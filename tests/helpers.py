import datetime as dt


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.UTC)


def found(df, *columns) -> list[tuple]:
    """Collected rows in a stable order."""
    data = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(data, key=lambda r: tuple((v is None, str(v)) for v in r))


def clock(df, *columns):
    """As `found`, instants as text."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    shown = df.select(*columns) if columns else df
    return found(shown.select([F.date_format(f.name, "yyyy-MM-dd HH:mm").alias(f.name) if isinstance(f.dataType, T.TimestampType)
                               else F.col(f.name) for f in shown.schema]))
