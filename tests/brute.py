"""The gap rules in plain Python, one nested loop after the other, for small inputs only."""

from collections import defaultdict
from datetime import date
from decimal import ROUND_HALF_UP, Decimal


def r2(x):
    if x is None:
        return None
    return float(Decimal(repr(x)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def gap_rows(t, p, min_chains=2):
    """{(entity, segment, city, vendor, name): [(group, rank, qty, chains, estimate)]}"""
    inside = lambda day, lo, hi: lo <= day <= hi
    wanted = lambda e: p.entities is None or e in p.entities

    newest = {}
    for e, master, created, products in t["catalog"]:
        for (product,) in products or []:
            if master is None or product is None:
                continue
            rank = (created is not None, created or date.min, [-ord(c) for c in master])
            if (e, product) not in newest or rank > newest[e, product][0]:
                newest[e, product] = (rank, master)
    groups = {"demand_alias": defaultdict(set), "supply_alias": defaultdict(set)}
    for name, of in groups.items():
        for row in t[name]:
            of[row[0], row[1]].add(row[2])
    bridge = defaultdict(set)
    for key, ds in groups["demand_alias"].items():
        for d in ds:
            bridge[key[0], d] |= groups["supply_alias"].get(key, set())

    def of(name, e, product):
        if (e, product) not in newest:
            return set()
        return groups[name].get((e, newest[e, product][1]), set())

    dims = {
        (v[0], v[2], v[3], v[4], v[7], v[8], v[11], v[12], v[13])
        for v in t["vendor_month"]
        if wanted(v[0]) and v[1] == p.period.report_month and v[6] is not None
        and "dark" not in v[6].lower() and v[9] is not True and v[10] is True
    }
    sessions = defaultdict(int)
    for e, v, _, _, _, _, s, _, _ in dims:
        sessions[e, v] = max(sessions[e, v], s or 0)

    rates = defaultdict(float)
    for e, v, product, day, rate in t["buyable_rate"]:
        if wanted(e) and inside(day, p.period.active_from, p.period.active_to):
            rates[e, v, product] += rate or 0
    active = {k for k, rate in rates.items() if rate > 0}

    catalog = {
        (e, v, a, seg, city, name, chain)
        for e, v, product in active
        for de, dv, name, chain, seg, city, *_ in dims if (de, dv) == (e, v)
        for a in of("supply_alias", e, product)
    }
    products = {
        (e, v, product, a, seg, city, chain)
        for e, v, product in active
        for de, dv, _, chain, seg, city, *_ in dims if (de, dv) == (e, v)
        for a in of("demand_alias", e, product)
    }

    sales = {}
    for e, v, day, ok, vertical, items in t["orders"]:
        if not (wanted(e) and ok is True):
            continue
        if not inside(day, p.period.orders_from, p.period.orders_to):
            continue
        if p.order_vertical_exclude and (
            vertical is None or vertical == p.order_vertical_exclude
        ):
            continue
        for product, qty, (paid,) in items or []:
            for pe, pv, pp, a, seg, city, chain in products:
                if (pe, pv, pp) == (e, v, product):
                    row = sales.setdefault((e, v, chain, seg, city, a), [0, Decimal(0)])
                    row[0] += qty or 0
                    row[1] += Decimal(repr(paid or 0.0))

    cells = defaultdict(list)
    for (e, v, chain, seg, city, a), (qty, revenue) in sales.items():
        cells[e, seg, city, a].append((v, qty, revenue))
    tops = defaultdict(list)
    for (e, seg, city, a), rows in cells.items():
        sellers = len({v for v, _, _ in rows})
        qty, revenue = sum(r[1] for r in rows), sum(r[2] for r in rows)
        if float(revenue) / sellers < p.min_avg_revenue or qty / sellers <= p.min_avg_qty:
            continue
        chains = {
            c[6] for c in catalog
            if c[0] == e and c[2] in bridge[e, a] and c[6] is not None
            and c[3] is not None and c[4] is not None and (c[3], c[4]) == (seg, city)
        }
        if len(chains) < min_chains:
            continue
        visits = sum(sessions[e, v] for v, _, _ in rows)
        rate = float(revenue) / visits if visits else None
        tops[e, seg, city].append((a, qty, len(chains), rate))
    ranked = {}
    for cell, rows in tops.items():
        for a, qty, chains, rate in rows:
            rank = 1 + sum(other[1] > qty for other in rows)
            if rank <= p.top_products:
                ranked.setdefault(cell, []).append((rank, a, qty, chains, rate))

    vendors = {(c[0], c[3], c[4], c[1], c[5]) for c in catalog}
    per_vendor = defaultdict(list)
    for e, seg, city, v, name in vendors:
        for rank, a, qty, chains, rate in ranked.get((e, seg, city), []):
            carries = any(c[0] == e and c[1] == v and c[2] in bridge[e, a] for c in catalog)
            if not carries:
                est = None if rate is None else r2(rate * sessions[e, v])
                per_vendor[e, seg, city, v].append((rank, a, name, qty, chains, est))
    out = defaultdict(list)
    for (e, seg, city, v), rows in per_vendor.items():
        for nth, (rank, a, name, qty, chains, est) in enumerate(
            sorted(rows)[: p.gaps_per_vendor], start=1
        ):
            out[e, seg, city, v, name].append((nth, a, rank, qty, chains, est))
    return dict(out)
