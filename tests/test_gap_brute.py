"""The whole job against plain Python on random inputs full of awkward rows."""

import random
from datetime import date, datetime

import pytest

from shelfwise import GapParams, Period, build_lookups, lazy, sku_gap
from tests import micro
from tests.brute import gap_rows

ENTITIES = ("GV_ES", "PY_AR")


def random_tables(seed: int) -> dict:
    r = random.Random(seed)
    vendors = [f"v{i}" for i in range(24)]
    products = [f"p{i:02d}" for i in range(14)]
    masters = [f"m{i:02d}" for i in range(10)]
    t = {name: [] for name in ("catalog", "demand_alias", "supply_alias", "vendor_month",
                               "buyable_rate", "orders", "vendor_users", "comms_attributes",
                               "sku_threshold")}
    for e in ENTITIES:
        for m in masters:
            created = r.choice([None, datetime(2026, 1, r.randint(1, 3))])
            listed = r.choices([*products, None], k=r.randint(0, 4))
            t["catalog"].append((e, m, created, [(p,) for p in listed] or None))
            for _ in range(r.choice([0, 1, 1, 1, 1, 1, 2])):
                t["demand_alias"].append(micro.demand(m, r.choice(masters[:8]), e))
            for _ in range(r.choice([0, 1, 1, 1, 1, 1, 2])):
                t["supply_alias"].append(micro.supply(m, r.choice(masters[:5]), e))
        t["catalog"].append((e, None, None, [(products[0],)]))
        for v in vendors:
            for _ in range(r.choice([1, 1, 2, 3])):
                t["vendor_month"].append(micro.vendor(
                    v, entity=e, name=r.choice(["A", "B"]), chain=r.choice([None, "1", "2", "3"]),
                    vertical=r.choice(["Shop"] * 8 + ["DarkStore", None]),
                    segment=r.choice(["grocery"] * 7 + ["kiosk", None]),
                    city=r.choice(["X"] * 7 + ["Y", None]),
                    key=r.choice([False] * 4 + [None, True]), online=r.choice([True] * 5 + [None]),
                    sessions=r.choice([None, 0, 70, 300]), gmv=r.choice([None, 0.0, 5000.0]),
                    score=r.choice([None, 10.0, 90.0]),
                    month=r.choice([micro.MONTH] * 4 + [date(2026, 4, 1)]),
                ))
            for p in r.sample(products, 7):
                for _ in range(2):
                    t["buyable_rate"].append(micro.buyable(
                        v, p, entity=e, rate=r.choice([0.0, 0.5, 0.5, None]),
                        day=r.choice([micro.DAY, date(2026, 5, 31), date(2026, 6, 1)]),
                    ))
            for _ in range(12):
                items = [
                    (r.choice(products), r.choice([1, 2, 3, None]),
                     r.choice([None, 1.25, 9.999, 20.0]))
                    for _ in range(r.randint(0, 3))
                ]
                t["orders"].append(micro.order(
                    v, *items, entity=e, ok=r.choice([True, True, False, None]),
                    vertical=r.choice(["shop", "darkstores", None]),
                    day=r.choice([micro.DAY, date(2026, 5, 1), date(2026, 4, 30)]),
                ))
            t["vendor_users"].append(micro.user(f"u{e}{v}", v, entity=e))
            t["comms_attributes"].append(micro.attribute(f"u{e}{v}"))
    return t


def spark_rows(result) -> dict:
    out = {}
    for row in result.collect():
        key = (row.global_entity_id, row.vertical_segment, row.city, row.platform_vendor_id,
               row.vendor_name)
        out[key] = [
            (n, row[f"gap{n}_alias_product_id"], row[f"gap{n}_market_rank"],
             row[f"gap{n}_market_qty_sold"], row[f"gap{n}_num_chains"],
             row[f"gap{n}_weighted_est_rev_eur"])
            for n in (1, 2, 3) if row[f"gap{n}_alias_product_id"] is not None
        ]
    return out


LOOSE = GapParams(
    period=micro.PERIOD, min_avg_revenue=2.0, min_avg_qty=1.0, top_products=3
)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_staged_job(spark, seed):
    t = random_tables(seed)
    expected = gap_rows(t, LOOSE)
    assert expected
    assert spark_rows(sku_gap(micro.sources(spark, **t), LOOSE)) == expected


def test_three_windows(spark):
    """Vendors of April, availability up to June, orders from the end of April."""
    t = random_tables(1)
    apart = Period(
        date(2026, 4, 1), date(2026, 5, 10), date(2026, 6, 1), date(2026, 4, 30), date(2026, 5, 9)
    )
    params = LOOSE.with_(period=apart, min_avg_qty=0.5, min_avg_revenue=1.0)
    expected = gap_rows(t, params)
    swapped = Period(apart.report_month, apart.orders_from, apart.orders_to, apart.active_from, apart.active_to)
    assert expected and expected != gap_rows(t, params.with_(period=swapped))
    assert spark_rows(sku_gap(micro.sources(spark, **t), params)) == expected


def test_without_any_broadcast(shuffled):
    t = random_tables(4)
    expected = gap_rows(t, LOOSE)
    assert expected
    assert spark_rows(sku_gap(micro.sources(shuffled, **t), LOOSE)) == expected


def test_one_lazy_plan_from_stored_lookups(spark):
    t = random_tables(5)
    src = micro.sources(spark, **t)
    params = LOOSE.with_(entities=("PY_AR",), order_vertical_exclude="darkstores")
    result = sku_gap(src, params, build_lookups(src), stage=lazy)
    expected = gap_rows(t, params)
    assert expected and all(key[0] == "PY_AR" for key in expected)
    assert spark_rows(result) == expected


@pytest.mark.parametrize("chains", [1, 3])
def test_other_chain_limits(spark, chains):
    t = random_tables(6)
    params = LOOSE.with_(min_chains=chains)
    expected = gap_rows(t, params, chains)
    assert expected
    assert spark_rows(sku_gap(micro.sources(spark, **t), params)) == expected
