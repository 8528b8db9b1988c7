"""Small hand-made inputs."""

import tempfile
from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

from shelfwise import GapParams, Period, Sources
from shelfwise.sources.schemas import INPUT_SCHEMAS

MONTH = date(2026, 5, 1)
PERIOD = Period.month(MONTH)
DAY = date(2026, 5, 10)
PARAMS = GapParams(period=PERIOD)


def sources(spark, **rows) -> Sources:
    """Inputs as parquet files, which spares a Python worker per scan."""
    root = tempfile.mkdtemp(prefix="shelfwise-micro-")
    frames = {}
    for name, ddl in INPUT_SCHEMAS.items():
        schema = StructType.fromDDL(ddl)
        arrow = to_arrow_schema(schema)
        pq.write_table(
            pa.Table.from_pylist([_record(schema, r) for r in rows.get(name, [])], arrow),
            f"{root}/{name}.parquet",
        )
        frames[name] = spark.read.schema(schema).parquet(f"{root}/{name}.parquet")
    return Sources(**frames)


def _record(kind, value):
    """Tuples of a struct as dicts, at any depth."""
    if value is None:
        return None
    if isinstance(kind, StructType):
        return {f.name: _record(f.dataType, v) for f, v in zip(kind.fields, value, strict=True)}
    if isinstance(kind, ArrayType):
        return [_record(kind.elementType, v) for v in value]
    return value


def vendor(v, *, entity="GV_ES", month=MONTH, name=None, chain=None, vertical="Shop",
           segment="grocery", city="Madrid", key=False, online=True, sessions=100, gmv=1000.0,
           score=60.0):
    return (entity, month, v, name or f"Shop {v}", chain, chain and f"Chain {chain}", vertical,
            segment, city, key, online, sessions, gmv, score)


def buyable(v, p, *, entity="GV_ES", day=DAY, rate=1.0):
    return (entity, v, p, day, rate)


def order(v, *items, entity="GV_ES", day=DAY, ok=True, vertical="shop"):
    """items: (product, quantity, paid)"""
    return (entity, v, day, ok, vertical, [(p, q, (paid,)) for p, q, paid in items])


def listing(master, *products, entity="GV_ES", created=datetime(2026, 1, 1)):
    return (entity, master, created, [(p,) for p in products])


def demand(master, group, entity="GV_ES", **show):
    return (entity, master, group, show.get("alias", f"alias {master}"), show.get("local"),
            show.get("english", f"english {master}"), f"bar {master}", f"img {master}")


def supply(master, group, entity="GV_ES"):
    return (entity, master, group)


def user(uuid, *vendors, gone=False, entity="GV_ES", node_gone=None):
    return (uuid, gone, [(v, entity, node_gone) for v in vendors])


def attribute(uuid, food="grocery"):
    return (uuid, food, "owner", False)


def plain_products(n, entity="GV_ES"):
    """Products p1..pn, each its own master product and group under both aliases."""
    ids = [f"p{i}" for i in range(1, n + 1)]
    return {
        "catalog": [listing(p, p, entity=entity) for p in ids],
        "demand_alias": [demand(p, p, entity) for p in ids],
        "supply_alias": [supply(p, p, entity) for p in ids],
    }
