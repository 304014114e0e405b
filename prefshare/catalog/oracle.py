"""SQL twins of the queries, for another engine over the same tables."""

from __future__ import annotations

from prefshare.catalog.queries import FIRST_RUN, FIRST_SCORED, ID_RANGE
from prefshare.catalog.tables import FIRST_TYPES, LAST_TYPES, PART_NAMES, PART_TYPES
from prefshare.functions import vocab

STEPS = vocab.STEP_LABELS

DURATION_CASE = """CASE WHEN {0} <= 1 THEN 'XS' WHEN {0} < 7 THEN 'S' WHEN {0} = 7 THEN 'M'
     WHEN {0} <= 15 THEN 'L' WHEN {0} >= 30 THEN 'XL' END"""
PRICE_CASE = """CASE WHEN {0} <= CAST(6.44 AS DOUBLE) THEN 'XS'
     WHEN {0} <= CAST(27.62 AS DOUBLE) THEN 'S'
     WHEN {0} <= 36 THEN 'M' WHEN {0} <= 111 THEN 'L' WHEN {0} > 111 THEN 'XL' END"""
PART_PRICE_CASE = """CASE WHEN {0} <= 910 THEN 'XS' WHEN {0} <= 930 THEN 'S'
     WHEN {0} <= 950 THEN 'M' WHEN {0} <= 975 THEN 'L' WHEN {0} > 975 THEN 'XL' END"""

# Named sub-selects, each using only those before it.
PARTS = {
    "purchases": """SELECT o_custkey AS analytic_id, l_partkey AS package_id,
       l_quantity AS total_transaction
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "named": """SELECT analytic_id, p_name AS package, total_transaction
  FROM purchases JOIN part ON package_id = p_partkey WHERE p_name IS NOT NULL""",
    "bought": "SELECT DISTINCT package FROM named",
    "bridge": """SELECT package_name, promotion_code, package FROM (
    SELECT o.p_brand AS package_name, o.p_partkey AS promotion_code, n.p_name AS package,
           row_number() OVER (PARTITION BY o.p_brand
                              ORDER BY o.p_partkey, n.p_name NULLS LAST) AS place
    FROM part o LEFT JOIN part n ON o.p_partkey = n.p_partkey) AS listed
  WHERE place = 1""",
    "attrs": """SELECT p_brand AS package_name, CAST(p_size AS DOUBLE) AS duration,
       p_retailprice AS price, p_type AS size FROM (
    SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS place
    FROM part) AS ranked
  WHERE place = 1""",
    "labels": f"""SELECT package, duration, price, size FROM (
    SELECT b.package, a.size,
           {DURATION_CASE.format('a.duration')} AS duration,
           {PART_PRICE_CASE.format('a.price')} AS price,
           row_number() OVER (PARTITION BY b.package
                              ORDER BY b.promotion_code, a.package_name) AS place
    FROM attrs a JOIN bridge b ON a.package_name = b.package_name
    WHERE a.size IS NOT NULL AND b.package IS NOT NULL) AS ranked
  WHERE place = 1""",
    "quantities": """SELECT analytic_id, package, sum(total_transaction) AS qty
  FROM named WHERE analytic_id IS NOT NULL GROUP BY analytic_id, package""",
    "totals": """SELECT analytic_id, sum(qty) AS total FROM quantities GROUP BY analytic_id""",
    "customers": """SELECT CAST(row_number() OVER (ORDER BY analytic_id) - 1 AS BIGINT) AS id,
       analytic_id FROM totals""",
    "labelled": """SELECT n.analytic_id, n.total_transaction AS q, n.package,
       l.duration, l.price, l.size
  FROM named n LEFT JOIN labels l ON n.package = l.package
  WHERE n.analytic_id IS NOT NULL""",
    "preferences": """SELECT CAST(row_number() OVER (ORDER BY package) - 1 AS BIGINT) AS id,
       package, duration, price, size
  FROM labels WHERE package IN (SELECT package FROM bought)""",
}

_NEEDS = {
    "purchases": (),
    "named": ("purchases",),
    "bought": ("named",),
    "bridge": (),
    "attrs": (),
    "labels": ("attrs", "bridge"),
    "quantities": ("named",),
    "totals": ("quantities",),
    "customers": ("totals",),
    "labelled": ("named", "labels"),
    "preferences": ("labels", "bought"),
}


def _with(names: tuple[str, ...], select: str) -> str:
    wanted: set[str] = set()

    def need(name: str) -> None:
        wanted.add(name)
        for n in _NEEDS[name]:
            need(n)

    for name in names:
        need(name)
    parts = [f"{n} AS (\n  {PARTS[n]})" for n in PARTS if n in wanted]
    return "WITH " + ",\n".join(parts) + "\n" + select


def _flags(column: str, labels: tuple[str, ...], prefix: str) -> str:
    return ",\n".join(
        f"CAST(CASE WHEN {column} = '{v}' THEN 1 ELSE 0 END AS INTEGER) AS {prefix}_{v}"
        for v in labels
    )


ALL_FLAGS = ",\n".join(
    (
        _flags("duration", STEPS, vocab.DURATION_PREFIX),
        _flags("price", STEPS, vocab.PRICE_PREFIX),
        _flags("size", PART_TYPES, vocab.SIZE_PREFIX),
    )
)

BINNED = f"""SELECT p_partkey, {DURATION_CASE.format('p_size')} AS duration,
  {PART_PRICE_CASE.format('p_retailprice')} AS price, p_type AS size FROM part"""


def _sums(column: str, labels: tuple[str, ...], prefix: str) -> str:
    return ",\n".join(
        f"sum(CASE WHEN {column} = '{v}' THEN q ELSE 0 END) AS {prefix}_{v}"
        for v in labels
    )


def _shares(column: str, labels: tuple[str, ...], prefix: str, digits: int = 0) -> str:
    def value(v: str) -> str:
        part = f"sum(CASE WHEN {column} = '{v}' THEN q ELSE 0 END) / nullif(sum(q), 0)"
        return f"round({part}, {digits})" if digits else part

    return ",\n".join(f"{value(v)} AS {prefix}_{v}" for v in labels)


def _score(select: str) -> str:
    return _with(
        ("labelled",),
        f"SELECT analytic_id,\n{select}\nFROM labelled GROUP BY analytic_id",
    )


def _wide(value: str, select: str, names: dict[str, str]) -> str:
    """One column per part name, 0 where a customer has none of it."""
    columns = ",\n".join(
        f"{value.format(f"sum(CASE WHEN q.package = '{name}' THEN q.qty ELSE 0 END)")} AS \"{column}\""
        for name, column in names.items()
    )
    return f"SELECT {select},\n{columns}\nFROM quantities q"


EVERY_PART = {name: name for name in PART_NAMES}


def _id_rows(column: str, labels: tuple[str, ...], prefix: str) -> str:
    return f"SELECT package, '{prefix}_' || {column} AS col FROM preferences WHERE {column} IN (" + (
        ", ".join(f"'{v}'" for v in labels) + ")"
    )


ORACLE: dict[str, str] = {
    "txn_csv_roundtrip": _with(
        ("purchases",),
        """SELECT CAST(analytic_id AS VARCHAR) AS analytic_id,
       CAST(package_id AS VARCHAR) AS package_id, total_transaction FROM purchases""",
    ),
    "tariff_csv_roundtrip": """SELECT CAST(p_partkey AS VARCHAR) AS promotion_code,
       p_brand AS package_name, p_name AS package FROM part""",
    "attr_csv_roundtrip": """SELECT p_name AS package_name, CAST(p_size AS DOUBLE) AS duration,
       p_retailprice AS price, p_type AS size FROM part""",
    "derived_dir_roundtrip": _with(
        ("labelled", "customers"),
        f"""SELECT c.id, CAST(c.analytic_id AS VARCHAR) AS analytic_id,
{_shares("l.duration", STEPS, vocab.DURATION_PREFIX, 9)},
{_shares("l.price", STEPS, vocab.PRICE_PREFIX, 9)}
FROM labelled l JOIN customers c ON l.analytic_id = c.analytic_id
GROUP BY c.id, c.analytic_id""",
    ),
    "score_text_vectors": _with(
        ("labelled", "customers"),
        f"""SELECT c.id AS key, {_sums("l.duration", STEPS, vocab.DURATION_PREFIX)}
FROM labelled l JOIN customers c ON l.analytic_id = c.analytic_id
GROUP BY c.id""",
    ),
    "persona_preview": _with(
        ("customers",), "SELECT id, analytic_id FROM customers ORDER BY id LIMIT 20"
    ),
    "name_bridge": _with(
        ("bridge",), "SELECT package_name, promotion_code, package FROM bridge"
    ),
    "attrs_with_new_name": _with(
        ("attrs", "bridge"),
        """SELECT a.package_name, a.duration, a.price, a.size, b.package
FROM attrs a LEFT JOIN bridge b ON a.package_name = b.package_name""",
    ),
    "dedupe_by_name": """SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS place
  FROM part) AS ranked WHERE place = 1""",
    "named_transactions": _with(
        ("named",), "SELECT analytic_id, package, total_transaction FROM named"
    ),
    "bought_packages": _with(("bought",), "SELECT package FROM bought"),
    "bin_duration": f"SELECT p_partkey, {DURATION_CASE.format('p_size')} AS duration FROM part",
    "bin_price": f"SELECT event_id, {PRICE_CASE.format('value')} AS price FROM events",
    "drop_missing_label": f"""SELECT p_partkey, duration FROM (
  SELECT p_partkey, {DURATION_CASE.format('p_size')} AS duration FROM part) AS binned
WHERE duration IS NOT NULL""",
    "one_hot_fixed": f"SELECT p_partkey,\n{ALL_FLAGS}\nFROM ({BINNED}) AS binned",
    "one_hot_discovered": f"""SELECT p_partkey, {_flags("p_type", PART_TYPES, "p_type")}
FROM part""",
    "distinct_labels": "SELECT DISTINCT p_type FROM part",
    "weighted_flags": _with(
        ("purchases",),
        "SELECT analytic_id, total_transaction,\n"
        + ",\n".join(
            f"CASE WHEN p_type = '{v}' THEN 1 ELSE 0 END * total_transaction AS type_{v}"
            for v in PART_TYPES
        )
        + "\nFROM purchases JOIN part ON package_id = p_partkey",
    ),
    "rename_unsafe": _with(
        ("quantities",),
        _wide(
            "{}",
            "q.analytic_id",
            {n: n.replace(" ", "_") for n in PART_NAMES if n != "red widget"},
        )
        + " GROUP BY q.analytic_id",
    ),
    "customer_total": _with(
        ("named",),
        """SELECT analytic_id, sum(total_transaction) AS total FROM named
WHERE analytic_id IS NOT NULL GROUP BY analytic_id""",
    ),
    "customer_count": _with(
        ("named",), "SELECT count(DISTINCT analytic_id) AS customers FROM named"
    ),
    "persona_qty_tall": _with(
        ("quantities",), "SELECT analytic_id, package, qty FROM quantities"
    ),
    "persona_qty_wide": _with(
        ("quantities",),
        _wide("{}", "q.analytic_id", EVERY_PART) + " GROUP BY q.analytic_id",
    ),
    "persona_share_tall": _with(
        ("totals",),
        """SELECT q.analytic_id, q.package, q.qty, t.total, q.qty / nullif(t.total, 0) AS share
FROM quantities q JOIN totals t ON q.analytic_id = t.analytic_id""",
    ),
    "persona_share_wide": _with(
        ("totals",),
        _wide("{} / nullif(t.total, 0)", "q.analytic_id", EVERY_PART)
        + """ JOIN totals t ON q.analytic_id = t.analytic_id
GROUP BY q.analytic_id, t.total""",
    ),
    "persona_share_sql": _with(
        ("totals",),
        _wide("{} / nullif(t.total, 0)", "q.analytic_id", EVERY_PART)
        + """ JOIN totals t ON q.analytic_id = t.analytic_id
GROUP BY q.analytic_id, t.total""",
    ),
    "customer_persona": _with(
        ("totals", "customers", "preferences"),
        """SELECT c.id, c.analytic_id, p.package,
  coalesce(q.qty, 0) / nullif(t.total, 0) AS share
FROM customers c JOIN totals t ON c.analytic_id = t.analytic_id CROSS JOIN preferences p
LEFT JOIN quantities q ON q.analytic_id = c.analytic_id AND q.package = p.package""",
    ),
    "sparse_persona": _with(
        ("totals", "customers", "preferences"),
        """SELECT c.id, c.analytic_id, t.total, e.place, e.package_id, e.qty,
  e.qty / nullif(t.total, 0) AS share
FROM customers c JOIN totals t ON c.analytic_id = t.analytic_id LEFT JOIN (
  SELECT q.analytic_id, p.id AS package_id, q.qty,
    CAST(row_number() OVER (PARTITION BY q.analytic_id ORDER BY p.id) - 1 AS INTEGER) AS place
  FROM quantities q JOIN preferences p ON q.package = p.package WHERE q.qty <> 0) e
ON e.analytic_id = c.analytic_id""",
    ),
    "months_replaced": _score(_shares("duration", STEPS, vocab.DURATION_PREFIX)),
    "ids_that_last": _with(
        ("totals",),
        f"""SELECT analytic_id, CAST(row_number() OVER (
    ORDER BY analytic_id % {FIRST_RUN} <> 0, analytic_id) - 1 AS BIGINT) AS id
FROM totals""",
    ),
    "scores_by_customer": _with(
        ("labelled", "customers"),
        f"""SELECT c.id, c.analytic_id,
{_shares("l.duration", STEPS, vocab.DURATION_PREFIX)},
{_shares("l.price", STEPS, vocab.PRICE_PREFIX)}
FROM labelled l JOIN customers c ON l.analytic_id = c.analytic_id
GROUP BY c.id, c.analytic_id""",
    ),
    "scores_in_ranges": _with(
        ("labelled", "customers"),
        f"""SELECT c.id, c.analytic_id,
{_shares("l.duration", STEPS, vocab.DURATION_PREFIX)}
FROM labelled l JOIN customers c ON l.analytic_id = c.analytic_id
GROUP BY c.id, c.analytic_id""",
    ),
    "bought_together": _with(
        ("quantities",),
        """SELECT a.package AS "row", b.package AS col, sum(a.qty * 1) AS "value"
FROM quantities a JOIN quantities b ON a.analytic_id = b.analytic_id
WHERE b.qty > 0 GROUP BY a.package, b.package""",
    ),
    "customer_index": _with(("customers",), "SELECT id, analytic_id FROM customers"),
    "id_range": _with(
        ("customers",),
        f"""SELECT id, analytic_id FROM customers
WHERE id BETWEEN {ID_RANGE[0]} AND {ID_RANGE[1]}""",
    ),
    "id_from": _with(
        ("customers",),
        f"SELECT id, analytic_id FROM customers WHERE id >= {FIRST_SCORED}",
    ),
    "range_union": _with(("customers",), "SELECT id, analytic_id FROM customers"),
    "package_index": _with(
        ("bought",),
        """SELECT CAST(row_number() OVER (ORDER BY package) - 1 AS BIGINT) AS id, package
FROM bought""",
    ),
    "package_preferences": _with(
        ("preferences",), f"SELECT id,\n{ALL_FLAGS}\nFROM preferences"
    ),
    "score_duration": _score(_shares("duration", STEPS, vocab.DURATION_PREFIX)),
    "score_price": _score(_shares("price", STEPS, vocab.PRICE_PREFIX)),
    "score_price_events": "WITH labelled AS (SELECT user_id AS analytic_id, CAST(1 AS DOUBLE) AS q,\n"
    + PRICE_CASE.format("value")
    + " AS price FROM events)\nSELECT analytic_id,\n"
    + _shares("price", STEPS, vocab.PRICE_PREFIX)
    + "\nFROM labelled GROUP BY analytic_id",
    "score_label_subset": _score(_shares("size", FIRST_TYPES, vocab.SIZE_PREFIX)),
    "score_label_rest": _score(_shares("size", LAST_TYPES, vocab.SIZE_PREFIX)),
    "scores_in_id_order": _with(
        ("labelled", "customers"),
        f"""SELECT c.id, c.analytic_id,
{_shares("l.duration", STEPS, vocab.DURATION_PREFIX)},
{_shares("l.price", STEPS, vocab.PRICE_PREFIX)},
{_shares("l.size", PART_TYPES, vocab.SIZE_PREFIX)}
FROM labelled l JOIN customers c ON l.analytic_id = c.analytic_id
GROUP BY c.id, c.analytic_id ORDER BY c.id""",
    ),
    "tall_dir_roundtrip": _with(
        ("labelled", "customers"),
        f"""SELECT c.id, c.analytic_id,
{_shares("l.duration", STEPS, vocab.DURATION_PREFIX)},
{_shares("l.price", STEPS, vocab.PRICE_PREFIX)},
{_shares("l.size", PART_TYPES, vocab.SIZE_PREFIX)}
FROM labelled l JOIN customers c ON l.analytic_id = c.analytic_id
GROUP BY c.id, c.analytic_id""",
    ),
    "score_raw_range": _with(
        ("labelled", "customers"),
        f"""SELECT c.id, c.analytic_id,
{_sums("CASE WHEN l.package <> 'red widget' THEN l.duration END", STEPS, vocab.DURATION_PREFIX)}
FROM labelled l JOIN customers c ON l.analytic_id = c.analytic_id
GROUP BY c.id, c.analytic_id""",
    ),
    "sparse_matmul": _with(
        ("quantities", "preferences"),
        f"""SELECT q.analytic_id AS "row", f.col, sum(q.qty) AS "value"
FROM quantities q JOIN (
  {_id_rows("duration", STEPS, vocab.DURATION_PREFIX)}
  UNION ALL {_id_rows("price", STEPS, vocab.PRICE_PREFIX)}
  UNION ALL {_id_rows("size", PART_TYPES, vocab.SIZE_PREFIX)}) AS f
ON q.package = f.package GROUP BY q.analytic_id, f.col""",
    ),
}
