"""The same queries as SQL text, for checking results with another engine."""

from __future__ import annotations

import re

from strandline.plans.catalog import DATE_TEXTS, STORED
from strandline.sources.adapters import COLUMNS, SPOILED

LINES = (
    "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"
)
CATEGORY = "CAST('0x' || substr(md5(p_type), 1, 7) AS INT) AS category_key"
SUBCATEGORY = (
    "CAST('0x' || substr(md5(concat(p_type, '|', p_brand)), 1, 7) AS INT) AS subcategory_key"
)
BASES = {
    "calendar": "(SELECT DISTINCT o_orderdate FROM orders)",
    "customers": "customer",
    "product_category": f"(SELECT DISTINCT p_type, {CATEGORY} FROM part)",
    "product_sub_category": f"(SELECT DISTINCT p_type, p_brand, {CATEGORY}, {SUBCATEGORY} FROM part)",
    "products": f"(SELECT *, {CATEGORY}, {SUBCATEGORY} FROM part)",
    "returns": f"(SELECT * FROM {LINES} WHERE l_returnflag = 'R')",
    "sales": f"(SELECT * FROM {LINES})",
    "territories": "(SELECT * FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)",
}
REPEATED = BASES | {
    "calendar": "(SELECT o_orderdate FROM orders)",
    "product_category": f"(SELECT p_type, {CATEGORY} FROM part)",
    "product_sub_category": f"(SELECT p_type, p_brand, {CATEGORY}, {SUBCATEGORY} FROM part)",
    "territories": "(SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey "
    "LEFT JOIN region ON n_regionkey = r_regionkey)",
}


def _date(text: str) -> str:
    layouts = ("%m/%d/%Y", "%m-%d-%Y", "%Y-%m-%d", "%d/%m/%Y")
    tries = ", ".join(f"try_strptime({text}, '{f}')" for f in layouts)
    return f"CAST(COALESCE({tries}) AS DATE)"


def _initcap(text: str) -> str:
    words = (
        f"list_transform(string_split({text}, ' '), "
        "lambda w: upper(left(w, 1)) || lower(substr(w, 2)))"
    )
    return f"trim(array_to_string({words}, ' '))"


def _upper(column: str, default: str = "Unknown") -> str:
    return f"trim(upper(COALESCE({column}, '{default}')))"


DAY = _date('"Date"')
CLEANED = {
    "calendar": {
        "Date": DAY,
        "year": f"CAST(year({DAY}) AS INT)",
        "month": f"CAST(month({DAY}) AS INT)",
        "quarter": f"CAST(quarter({DAY}) AS INT)",
        "dayOfMonth": f"CAST(day({DAY}) AS INT)",
        "DayName": f"dayname({DAY})",
        "IsWeekend": f"COALESCE(dayofweek({DAY}) IN (0, 6), FALSE)",
    },
    "customers": {
        "CustomerKey": "CustomerKey",
        "Prefix": "COALESCE(Prefix, 'Unknown')",
        "FirstName": _upper("FirstName"),
        "LastName": _upper("LastName"),
        "BirthDate": _date("BirthDate"),
        "MaritalStatus": _upper("MaritalStatus"),
        "Gender": _upper("Gender"),
        "EmailAddress": "EmailAddress",
        "AnnualIncome": r"TRY_CAST(regexp_replace(AnnualIncome, '[\$\s,]', '', 'g') AS DOUBLE)",
        "TotalChildren": "COALESCE(TotalChildren, 0)",
        "EducationLevel": "trim(COALESCE(EducationLevel, 'Unknown'))",
        "Occupation": "trim(COALESCE(Occupation, 'Unknown'))",
        "HomeOwner": "HomeOwner",
    },
    "product_category": {
        "ProductCategoryKey": "ProductCategoryKey",
        "CategoryName": _initcap("COALESCE(CategoryName, 'Unknown')"),
    },
    "product_sub_category": {
        "ProductSubcategoryKey": "ProductSubcategoryKey",
        "ProductCategoryKey": "ProductCategoryKey",
        "SubcategoryName": _initcap("COALESCE(SubcategoryName, 'Unknown')"),
    },
    "products": {
        "ProductKey": "ProductKey",
        "ProductSubcategoryKey": "ProductSubcategoryKey",
        "ProductSKU": "trim(COALESCE(ProductSKU, 'Unknown'))",
        "ProductName": _upper("ProductName"),
        "ModelName": _upper("ModelName"),
        "ProductDescription": _upper("ProductDescription"),
        "ProductColor": _upper("ProductColor", "NA"),
        "ProductSize": _upper("ProductSize", "NA"),
        "ProductStyle": _upper("ProductStyle", "NA"),
        "ProductCost": "TRY_CAST(ProductCost AS DOUBLE)",
        "ProductPrice": "TRY_CAST(ProductPrice AS DOUBLE)",
    },
    "returns": {
        "ReturnKey": f"md5(concat_ws('||', COALESCE(CAST({_date('ReturnDate')} AS STRING), "
        "'DEFAULT_DATE'), COALESCE(CAST(TerritoryKey AS STRING), '-1'), "
        "COALESCE(CAST(ProductKey AS STRING), '-1')))",
        "ReturnDate": _date("ReturnDate"),
        "TerritoryKey": "TerritoryKey",
        "ProductKey": "ProductKey",
        "ReturnQuantity": "abs(ReturnQuantity)",
    },
    "sales": {
        "OrderDate": _date("OrderDate"),
        "StockDate": _date("StockDate"),
        "OrderNumber": "trim(OrderNumber)",
        "ProductKey": "ProductKey",
        "CustomerKey": "CustomerKey",
        "TerritoryKey": "TerritoryKey",
        "OrderLineItem": "OrderLineItem",
        "OrderQuantity": "abs(OrderQuantity)",
    },
    "territories": {
        "SalesTerritoryKey": "SalesTerritoryKey",
        "Region": f"COALESCE({_initcap('Region')}, 'Unknown')",
        "Country": f"COALESCE({_initcap('Country')}, 'Unknown')",
        "Continent": f"COALESCE({_initcap('Continent')}, 'Unknown')",
    },
}
GATES = {
    "calendar": '"Date" IS NOT NULL AND year IS NOT NULL AND month IS NOT NULL',
    "customers": "CustomerKey IS NOT NULL",
    "product_category": "ProductCategoryKey IS NOT NULL",
    "product_sub_category": "ProductSubcategoryKey IS NOT NULL",
    "products": "ProductKey IS NOT NULL",
    "returns": "ReturnKey IS NOT NULL",
    "sales": "OrderNumber IS NOT NULL AND OrderLineItem IS NOT NULL AND OrderDate IS NOT NULL",
    "territories": "SalesTerritoryKey IS NOT NULL",
}
KEYS = {
    "calendar": '"Date"',
    "customers": "CustomerKey",
    "product_category": "ProductCategoryKey",
    "product_sub_category": "ProductSubcategoryKey",
    "products": "ProductKey",
    "returns": "ReturnKey",
    "sales": "OrderNumber, OrderLineItem",
    "territories": "SalesTerritoryKey",
}
ARRIVED = {
    "sales": "ingestion_timestamp DESC NULLS LAST, ProductKey NULLS FIRST, tie2",
    "returns": "ingestion_timestamp DESC NULLS LAST, tie1, tie2, tie3",
}


def _names(source: str) -> str:
    return ", ".join(f'"{c}"' for c in CLEANED[source])


def _untimed(source: str) -> str:
    keys = KEYS[source].replace('"', "").split(", ")
    return ", ".join(f'"{c}" ASC NULLS FIRST' for c in CLEANED[source] if c not in keys)


def _select(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in columns.items()) + f" FROM {source}"


def _extras(source: str) -> dict[str, str]:
    return {c: c for c in COLUMNS[source] if c.startswith("tie") or c == "ingestion_timestamp"}


def _newest(rows: str, keys: str, order: str, columns: str) -> str:
    ranked = f"SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rk FROM {rows}"
    return f"SELECT {columns} FROM ({ranked}) WHERE rk = 1"


def _layer(
    prefix: str, source: str, bases: dict[str, str], spoiled: bool, where: str = "", changed: dict | None = None
) -> dict:
    """raw, clean, gate and silver steps of one source, names starting with ``prefix``."""
    raw = COLUMNS[source] | (SPOILED[source] if spoiled else {}) | (changed or {})
    base = f"(SELECT * FROM {bases[source]} WHERE {where})" if where else bases[source]
    order = ARRIVED.get(source) or _untimed(source)
    return {
        f"{prefix}raw_{source}": _select(raw, base),
        f"{prefix}clean_{source}": _select(
            CLEANED[source] | _extras(source), f"{prefix}raw_{source}"
        ),
        f"{prefix}gate_{source}": f"SELECT * FROM {prefix}clean_{source} WHERE {GATES[source]}",
        f"{prefix}silver_{source}": _newest(
            f"{prefix}gate_{source}", KEYS[source], order, _names(source)
        ),
    }


FACT_COLUMNS = (
    "s.OrderDate, s.StockDate, s.OrderNumber, s.ProductKey, s.CustomerKey, s.TerritoryKey, "
    "s.OrderLineItem, s.OrderQuantity, CAST(p.ProductPrice AS DECIMAL(18,4)) AS ProductPrice, "
    "CAST(p.ProductCost AS DECIMAL(18,4)) AS ProductCost, "
    "CAST(s.OrderQuantity * p.ProductPrice AS DECIMAL(18,4)) AS Revenue, "
    "CAST(s.OrderQuantity * p.ProductCost AS DECIMAL(18,4)) AS Cost, "
    "CAST(s.OrderQuantity * p.ProductPrice - s.OrderQuantity * p.ProductCost "
    "AS DECIMAL(18,4)) AS Profit"
)


def _fact(rows: str) -> str:
    return (
        f"SELECT {FACT_COLUMNS} FROM {rows} s "
        "LEFT JOIN silver_products p ON s.ProductKey = p.ProductKey"
    )


STEPS: dict[str, str] = {}
for _s in COLUMNS:
    STEPS |= _layer("", _s, BASES, False)
    STEPS |= _layer("bad_", _s, BASES, True)
    STEPS |= _layer("many_", _s, REPEATED, True)
for _p, _w in (("first_", "l_linestatus = 'F'"), ("later_", "l_linestatus = 'O'")):
    STEPS |= _layer(_p, "sales", BASES, False, _w)
    STEPS |= _layer(f"bad_{_p}", "sales", BASES, True, _w)
    _more = {"OrderQuantity": f"{COLUMNS['sales']['OrderQuantity']} + 1"}
    STEPS |= _layer(f"more_{_p}", "sales", BASES, False, _w, _more)
STEPS |= {
    "dim_customers": "SELECT CustomerKey, Prefix, concat_ws(' ', FirstName, LastName) AS FullName, "
    "BirthDate, MaritalStatus, Gender, EmailAddress, AnnualIncome, TotalChildren, "
    "EducationLevel, Occupation, HomeOwner FROM silver_customers",
    "dim_date": 'SELECT "Date", year AS "Year", month AS "Month", quarter AS "Quarter", '
    'dayOfMonth AS "DayOfMonth", DayName, IsWeekend, '
    "strftime(\"Date\", '%b') AS MonthName FROM silver_calendar",
    "dim_products": "SELECT p.ProductKey, p.ProductName, p.ProductSKU, p.ModelName, "
    "p.ProductDescription, p.ProductColor, p.ProductSize, p.ProductStyle, "
    "c.ProductCategoryKey, c.CategoryName, s.ProductSubcategoryKey, s.SubcategoryName, "
    "CAST(p.ProductCost AS DECIMAL(10,4)) AS ProductCost, "
    "CAST(p.ProductPrice AS DECIMAL(10,4)) AS ProductPrice FROM silver_products p "
    "LEFT JOIN silver_product_sub_category s "
    "ON p.ProductSubcategoryKey = s.ProductSubcategoryKey "
    "LEFT JOIN silver_product_category c ON s.ProductCategoryKey = c.ProductCategoryKey",
    "dim_territories": "SELECT SalesTerritoryKey AS TerritoryKey, Region, Country, Continent "
    "FROM silver_territories",
    "fact_sales": _fact("silver_sales"),
    "fact_returns": "SELECT * FROM silver_returns",
    "wide_sales": "SELECT f.*, p.CategoryName, p.ProductName, c.FullName, c.Occupation, c.Gender, "
    't.Region, t.Country, d."Year", d."Month", d.MonthName FROM fact_sales f '
    "LEFT JOIN dim_products p ON f.ProductKey = p.ProductKey "
    "LEFT JOIN dim_customers c ON f.CustomerKey = c.CustomerKey "
    "LEFT JOIN dim_territories t ON f.TerritoryKey = t.TerritoryKey "
    'LEFT JOIN dim_date d ON f.OrderDate = d."Date"',
    "wide_returns": "SELECT f.*, p.CategoryName, p.ProductName, p.ProductPrice, t.Region, "
    't.Country, d."Year" FROM fact_returns f '
    "LEFT JOIN dim_products p ON f.ProductKey = p.ProductKey "
    "LEFT JOIN dim_territories t ON f.TerritoryKey = t.TerritoryKey "
    'LEFT JOIN dim_date d ON f.ReturnDate = d."Date"',
    # A calendar without gaps, and for each of its days the day a year earlier.
    "days": 'SELECT CAST(unnest(generate_series(mn, mx, INTERVAL 1 DAY)) AS DATE) AS "Date" '
    "FROM (SELECT min(CAST(o_orderdate AS DATE)) mn, max(CAST(o_orderdate AS DATE)) mx "
    "FROM orders)",
    "dated": 'SELECT "Date", CAST(year("Date") AS INT) AS "Year", '
    'CAST(month("Date") AS INT) AS "Month", CAST("Date" - INTERVAL 1 YEAR AS DATE) AS Before '
    "FROM days",
    "daily": "SELECT OrderDate, sum(Revenue) AS Revenue, sum(Profit) AS Profit "
    "FROM fact_sales GROUP BY OrderDate",
}


# The same out of one CSV drop, where only columns break ties.
for _s in ("sales", "returns"):
    STEPS[f"landed_{_s}"] = _newest(f"gate_{_s}", KEYS[_s], _untimed(_s), _names(_s))
STEPS["landed_fact_sales"] = _fact("landed_sales")
STEPS["landed_fact_returns"] = "SELECT * FROM landed_returns"
for _s in ("wide_sales", "wide_returns"):
    STEPS[f"landed_{_s}"] = re.sub(r"\bfact_", "landed_fact_", STEPS[_s])


def _with(sql: str) -> str:
    """``sql`` preceded by the steps it needs, each after the ones it needs itself."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"[a-z_]+", text)):
            if name in STEPS and name not in order:
                visit(STEPS[name])
                order.append(name)

    visit(sql)
    steps = ", ".join(f"{name} AS ({STEPS[name]})" for name in order)
    return f"WITH {steps} {sql}" if steps else sql


def _double(expr: str, name: str) -> str:
    return f'CAST({expr} AS DOUBLE) AS "{name}"'


def _ratio(top: str, bottom: str, name: str) -> str:
    top, bottom = f"CAST({top} AS DOUBLE)", f"CAST({bottom} AS DOUBLE)"
    safe = f"CASE WHEN {bottom} IS NULL OR {bottom} = 0 THEN 0.0 ELSE {top} / {bottom} END"
    return f"round({safe}, 6) AS {name}"


def _grouped(expr: str, by: str, rows: str = "wide_sales") -> str:
    return f"SELECT {by}, {expr} FROM {rows} GROUP BY {by}"


def _top(expr: str, name: str, by: str, rows: str, n: int) -> str:
    ranked = (
        f"SELECT {by}, {expr} AS m, rank() OVER (ORDER BY {expr} DESC NULLS LAST) AS place "
        f"FROM {rows} GROUP BY {by}"
    )
    return f"SELECT {by}, {_double('m', name)} FROM ({ranked}) WHERE place <= {n}"


def _distinct(column: str) -> str:
    return f"(count(DISTINCT {column}) + CAST(count(*) > count({column}) AS INT))"


REVENUE = _double("sum(Revenue)", "revenue")
PROFIT = _double("sum(Profit)", "profit")
AMOUNT = _double("sum(ReturnQuantity * ProductPrice)", "total_return_amount")


def _return_rate(where_sales: str = "", where_returns: str = "") -> str:
    sold = f"SELECT CategoryName, sum(OrderQuantity) AS q FROM wide_sales {where_sales} GROUP BY 1"
    back = (
        f"SELECT CategoryName, sum(ReturnQuantity) AS q FROM wide_returns {where_returns} "
        "GROUP BY 1"
    )
    return (
        f"SELECT g.CategoryName, {_ratio('r.q', 's.q', 'return_rate')} "
        "FROM (SELECT DISTINCT CategoryName FROM dim_products) g "
        f"LEFT JOIN ({sold}) s ON g.CategoryName IS NOT DISTINCT FROM s.CategoryName "
        f"LEFT JOIN ({back}) r ON g.CategoryName IS NOT DISTINCT FROM r.CategoryName"
    )


def _last_year(
    measure: str, by: str, month_ends: bool = True, growth: bool = False, chosen: str = "dated"
) -> str:
    """Measure per period and over the same period of the year before.

    ``chosen`` are the days of the report; the year before is looked up in all days.
    """
    low = measure.lower()
    keys = by.split(", ") if by else []
    listed = f"{by}, " if by else ""
    shifted = f"SELECT {listed}Before AS d FROM {chosen}"
    if month_ends:
        leap = (
            f"SELECT {listed}last_day(Before) AS d FROM {chosen} WHERE month(\"Date\") = 2 "
            "AND day(\"Date\") IN (27, 28) AND day(last_day(Before)) = 29 "
            f"GROUP BY {listed}last_day(Before) HAVING count(*) = 2"
        )
        shifted = f"{shifted} UNION {leap}"
    known = f'SELECT DISTINCT * FROM ({shifted}) WHERE d IN (SELECT "Date" FROM days)'
    group = f" GROUP BY {by}" if by else ""
    now = (
        f"SELECT {listed}sum({measure}) AS now FROM {chosen} "
        f'JOIN daily ON "Date" = OrderDate{group}'
    )
    past = f"SELECT {listed}sum({measure}) AS past FROM ({known}) JOIN daily ON d = OrderDate{group}"
    match = " AND ".join(f"n.{k} = p.{k}" for k in keys) or "TRUE"
    shown = "".join(f"n.{k}, " for k in keys)
    columns = f"{shown}{_double('now', low)}, {_double('past', low + '_ly')}"
    if growth:
        columns += ", " + _ratio("(now - past)", "past", f"{low}_yoy_pct")
    return f"SELECT {columns} FROM ({now}) n LEFT JOIN ({past}) p ON {match}"


def _spine(ends: str) -> str:
    day = 'SELECT CAST(unnest(generate_series(make_date(lo, 1, 1), make_date(hi, 12, 31), INTERVAL 1 DAY)) AS DATE) AS "Date"'
    return (
        'SELECT "Date", CAST(year("Date") AS INT) AS "Year", '
        'CAST(month("Date") AS INT) AS "MonthNo", monthname("Date") AS "Month", '
        'CAST(quarter("Date") AS INT) AS "QuarterNo", '
        "'Qtr ' || CAST(quarter(\"Date\") AS STRING) AS \"Quarter\", "
        'CAST(day("Date") AS INT) AS "Day" '
        f"FROM ({day} FROM ({ends}))"
    )


def _hierarchy(daily: str) -> str:
    """``daily`` yields (d, revenue); one row per year, quarter, month, day and in all."""
    parts = (
        f"SELECT d, r, CAST(year(d) AS INT) AS y, CAST(quarter(d) AS INT) AS q, "
        f"CAST(month(d) AS INT) AS m, CAST(day(d) AS INT) AS dd FROM ({daily})"
    )
    level = "4 - CAST(bit_count(grouping(y, q, m, dd)) AS INT)"
    rolled = (
        f"SELECT {level} AS level, y, q, m, dd, sum(r) AS r FROM ({parts}) "
        "GROUP BY ROLLUP (y, q, m, dd)"
    )
    return (
        'SELECT level, y AS "Year", '
        "CASE WHEN level >= 2 THEN 'Qtr ' || CAST(q AS STRING) END AS \"Quarter\", "
        'm AS "MonthNo", '
        'CASE WHEN level >= 3 THEN monthname(make_date(2000, m, 1)) END AS "Month", '
        f'dd AS "Day", {_double("r", "revenue")} FROM ({rolled})'
    )


PERIOD = "level, y, q, m, dd"


def _rolled(expr: str, rows: str, date: str, by: str = "", days: str = "", join: str = "LEFT") -> str:
    """``expr`` per period of every level; rows without a calendar day form a blank period."""
    days = days or "dim_date"
    parts = (
        'SELECT f.*, CAST(year(k."Date") AS INT) AS y, CAST(quarter(k."Date") AS INT) AS q, '
        'CAST(month(k."Date") AS INT) AS m, CAST(day(k."Date") AS INT) AS dd '
        f'FROM ({rows}) f {join} JOIN {days} k ON f.{date} = k."Date"'
    )
    listed = f"{by}, " if by else ""
    return (
        f"SELECT {listed}4 - CAST(bit_count(grouping(y, q, m, dd)) AS INT) AS level, y, q, m, dd{', ' if expr else ''}{expr} "
        f"FROM ({parts}) GROUP BY {listed}ROLLUP (y, q, m, dd)"
    )


def _named_periods(columns: str, rows: str, by: str = "") -> str:
    return (
        f"SELECT {by + ', ' if by else ''}level, y AS \"Year\", CASE WHEN level >= 2 THEN 'Qtr ' || CAST(q AS STRING) END AS \"Quarter\", "
        "m AS \"MonthNo\", CASE WHEN level >= 3 THEN monthname(make_date(2000, m, 1)) END AS \"Month\", "
        f'dd AS "Day", {columns} FROM ({rows})'
    )


def _drills() -> dict[str, str]:
    sold = _rolled(f"{_distinct('OrderNumber')} AS o, sum(OrderQuantity) AS s", "SELECT * FROM fact_sales", "OrderDate")
    back = _rolled("sum(ReturnQuantity) AS r", "SELECT * FROM fact_returns", "ReturnDate")
    every = _rolled("", 'SELECT "Date" AS day_of FROM dim_date', "day_of")
    both = f"SELECT {PERIOD}, max(o) AS o, max(s) AS s, max(r) AS r FROM ({sold} UNION ALL BY NAME {back} UNION ALL BY NAME {every}) GROUP BY ALL"
    country = "SELECT f.*, t.Country FROM fact_sales f LEFT JOIN dim_territories t ON f.TerritoryKey = t.TerritoryKey"
    bought = _rolled(
        f"{_distinct('CustomerKey')} AS c, {_distinct('OrderNumber')} AS o, sum(Revenue) AS v", country, "OrderDate", "Country",
        '(SELECT * FROM dim_date WHERE "Year" = 1997)', "INNER",
    )
    labels = ", ".join(
        f'CASE WHEN level > {k} THEN CAST({part}("Date") AS INT) END AS {name}'
        for k, (name, part) in enumerate({"y": "year", "q": "quarter", "m": "month", "dd": "day"}.items())
    )
    spread = f'(SELECT "Date", Before, level::INT AS level, {labels} FROM dated, range(0, 5) t(level))'
    shifted = (
        f"SELECT {PERIOD}, Before AS d FROM {spread} UNION SELECT {PERIOD}, last_day(Before) FROM {spread} "
        'WHERE month("Date") = 2 AND day("Date") IN (27, 28) AND day(last_day(Before)) = 29 '
        f"GROUP BY {PERIOD}, last_day(Before) HAVING count(*) = 2"
    )
    past = (
        f'SELECT {PERIOD}, sum(Revenue) AS past FROM ({shifted}) JOIN daily ON d = OrderDate '
        f'WHERE d IN (SELECT "Date" FROM days) GROUP BY {PERIOD}'
    )
    now = f'SELECT {PERIOD}, sum(Revenue) AS now FROM {spread} LEFT JOIN daily ON "Date" = OrderDate GROUP BY {PERIOD}'
    years = f"SELECT {PERIOD}, max(now) AS now, max(past) AS past FROM ({now} UNION ALL BY NAME {past}) GROUP BY ALL"
    growth = _ratio("(COALESCE(now, 0) - COALESCE(past, 0))", "past", "revenue_yoy_pct")
    return {
        "drill_orders_by_date": _named_periods(f"o AS total_orders, {_ratio('r', 's', 'return_rate')}", both),
        "drill_customers_by_country": _named_periods(
            f"c AS total_customers, o AS total_orders, {_double('v', 'revenue')}", bought, "Country"
        ),
        "drill_last_year": _named_periods(f"{_double('now', 'revenue')}, {_double('past', 'revenue_ly')}, {growth}", years),
    }


def _nulls(*columns: str) -> list[tuple[str, str]]:
    return [(f"Required Column: {c}", f'count(*) - count("{c}")') for c in columns]


def _blanks(*columns: str) -> list[tuple[str, str]]:
    return [(f"Required Column: {c}", _hits(f"COALESCE(trim({c}), '') = ''")) for c in columns]


def _hits(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


# Rule names, stated here anew so that a changed rule shows, and how to count the rows
# that break them.
COUNTED: dict[str, list[tuple[str, str]]] = {
    "calendar": [
        *_nulls("Date", "year", "month", "quarter", "dayOfMonth", "IsWeekend"),
        *_blanks("DayName"),
        ("Logical Bounds: Valid Month (1-12)", _hits("NOT month BETWEEN 1 AND 12")),
        ("Logical Bounds: Valid Quarter (1-4)", _hits("NOT quarter BETWEEN 1 AND 4")),
        ("Logical Bounds: Valid Day (1-31)", _hits("NOT dayOfMonth BETWEEN 1 AND 31")),
    ],
    "customers": [
        ("Valid Primary Keys", "count(*) - count(CustomerKey)"),
        ("Email Format Check", _hits(r"NOT COALESCE(regexp_matches(EmailAddress, '(?s)@.*\.'), FALSE)")),
    ],
    "product_category": [
        ("Mandatory Core Columns", "count(*) - count(ProductCategoryKey)"),
        ("Required String Columns", _hits("COALESCE(trim(CategoryName), '') = ''")),
    ],
    "product_sub_category": [
        *_nulls("ProductSubcategoryKey", "ProductCategoryKey"), *_blanks("SubcategoryName"),
    ],
    "products": [
        *_nulls("ProductKey", "ProductSubcategoryKey"),
        *_blanks("ProductSKU", "ProductName"),
        ("Financial Logic: Non-Negative Values", _hits("least(ProductPrice, ProductCost) < 0")),
        ("Business Rule: Price Greater Than Cost", _hits("ProductCost > ProductPrice")),
    ],
    "returns": [
        *_blanks("ReturnKey"),
        *_nulls("ReturnDate", "TerritoryKey", "ProductKey"),
        ("Operational Rule: Quantity > 0", _hits("NOT ReturnQuantity > 0")),
    ],
    "sales": [
        *_nulls(
            "OrderNumber", "OrderLineItem", "ProductKey", "CustomerKey", "TerritoryKey", "OrderDate",
            "StockDate",
        ),
        ("Logical Bounds: OrderQuantity > 0", _hits("NOT OrderQuantity > 0")),
    ],
    "territories": [*_nulls("SalesTerritoryKey"), *_blanks("Region", "Country", "Continent")],
}
WARNS = "Business Rule: Price Greater Than Cost"


def _report(source: str, rows: str) -> str:
    counting = "Row Count Check" if source == "customers" else "Row Count Verification"
    lines = [(counting, "FAIL", "0")]
    twice = (
        f"(SELECT COALESCE(sum(n), 0) FROM (SELECT count(*) AS n FROM {rows} "
        f"GROUP BY {KEYS[source]}) WHERE n > 1)"
    )
    lines.append(("Unique Primary Key Grain", "FAIL", twice))
    for name, counted in COUNTED[source]:
        breach = "WARNING" if name == WARNS else "FAIL"
        lines.append((name, breach, f"(SELECT {counted} FROM {rows})"))
    return " UNION ALL ".join(
        f"SELECT '{source}' AS table_name, '{name}' AS rule_name, "
        f"CASE WHEN n = 0 THEN 'PASS' ELSE '{breach}' END AS status, "
        f"CAST(n AS BIGINT) AS failed_rows FROM (SELECT {count} AS n)"
        for name, breach, count in lines
    )


def _merge(first: str, later: str, keys: str) -> str:
    same = " AND ".join(f"l.{k} = f.{k}" for k in keys.split(", "))
    return (
        f"SELECT f.* FROM {first} f WHERE NOT EXISTS (SELECT 1 FROM {later} l WHERE {same}) "
        f"UNION ALL SELECT * FROM {later}"
    )


def _events(where: str, loose: bool = False) -> str:
    user = "CASE WHEN user_id % 10 <> 0 THEN user_id END AS user_id" if loose else "user_id"
    picked = f"(SELECT * FROM events WHERE {where})"
    newest = _newest(picked, "user_id", "ts DESC, event_id", "*")
    return f"(SELECT event_id, ts, {user}, event_type, value, props FROM ({newest}))"


EARLY, LATE = "ts < TIMESTAMP '2024-01-21'", "ts >= TIMESTAMP '2024-01-21'"

# Streamed drops: all rows of a drop arrive at one instant, the later drop wins.
STREAMED = _merge(
    "(" + _newest("first_gate_sales", KEYS["sales"], _untimed("sales"), _names("sales")) + ")",
    "(" + _newest("later_gate_sales", KEYS["sales"], _untimed("sales"), _names("sales")) + ")",
    "OrderNumber, OrderLineItem",
)


def _arrived(prefix: str) -> str:
    """Sales of one drop, where only columns break ties."""
    rows = f"{prefix}gate_sales"
    return "(" + _newest(rows, KEYS["sales"], _untimed("sales"), _names("sales")) + ")"


def _cuts() -> str:
    """Three drops of sales, the last of which repeats the first one's keys."""
    keys = "OrderNumber, OrderLineItem"
    last = f"({_merge(_arrived('more_first_'), _arrived('more_later_'), keys)})"
    return f"SELECT *, unnest([1, 1000])::INT AS cut FROM ({_merge(last, _arrived('first_'), keys)})"


def _gated() -> str:
    """Rule rows of every source as one drop leaves them in Silver, where the gate stops."""
    parts = " UNION ALL ".join(_report(s, f"silver_{s}") for s in COLUMNS)
    return f"SELECT *, FALSE AS gold_loaded FROM ({parts})"


def _layers() -> str:
    rules = 2 + len(COUNTED["customers"])
    rows = "(SELECT count(*) FROM raw_customers)"
    counts = {"bronze": rows, "silver": rows, "gold": rows, "data_quality_check": str(rules)}
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, CAST({n} AS BIGINT) AS \"rows\", TRUE AS inside" for layer, n in counts.items()
    )


def _landed(sales: str = "", category: str = "s.CategoryName") -> str:
    """Sales and returns as they come out of one CSV drop, where only columns break ties."""
    sales = sales or _newest("gate_sales", KEYS["sales"], _untimed("sales"), _names("sales"))
    returns = _newest("gate_returns", KEYS["returns"], _untimed("returns"), _names("returns"))
    by = "FROM {} f LEFT JOIN dim_products p ON f.ProductKey = p.ProductKey GROUP BY 1"
    sold = (
        "SELECT CategoryName, sum(Revenue) AS revenue, "
        "count(DISTINCT OrderNumber) AS total_orders, sum(OrderQuantity) AS q "
        + by.format(f"({_fact(f'({sales})')})")
    )
    back = "SELECT CategoryName, sum(ReturnQuantity) AS q " + by.format(f"({returns})")
    return (
        f"SELECT {category} AS CategoryName, {_double('s.revenue', 'revenue')}, s.total_orders, "
        f"{_ratio('r.q', 's.q', 'return_rate')} FROM ({sold}) s LEFT JOIN ({back}) r "
        "ON s.CategoryName IS NOT DISTINCT FROM r.CategoryName"
    )


FEW_SALES = f"(SELECT c_nationkey AS piece FROM {LINES} WHERE l_quantity > 49 AND l_linenumber = 7)"


def _landing(answer: str, files: str, pieces: dict[str, str]) -> str:
    """Files per source: one for each value in the column ``piece``, a null being one."""
    counts = " ".join(f"WHEN '{source}' THEN (SELECT {_distinct('piece')} FROM {rows})" for source, rows in pieces.items())
    sources = ", ".join(f"('{s}')" for s in COLUMNS)
    return (
        f"SELECT source, n > 0 AS {answer}, CAST(n AS BIGINT) AS {files} "
        f"FROM (SELECT source, CASE source {counts} ELSE 0 END AS n FROM (VALUES {sources}) t(source))"
    )


LANDED = {
    "customers": "(SELECT Occupation AS piece FROM raw_customers)",
    "products": "(SELECT ProductSize AS piece FROM raw_products)",
    "territories": "(SELECT Country AS piece FROM raw_territories)",
    "returns": "(SELECT TerritoryKey AS piece FROM raw_returns)",
    "sales": FEW_SALES,
}
CHANGED = {"sales": FEW_SALES, "customers": "(SELECT c_custkey % 3 AS piece FROM customer WHERE c_acctbal > 0)"}


def _money(columns: str, rows: str) -> str:
    money = ("ProductPrice", "ProductCost", "Revenue", "Cost", "Profit")
    present = re.findall(r"\w+", columns)
    replaced = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in money if c in present)
    return f"SELECT * REPLACE ({replaced}) FROM {rows}"


IN_1997 = '(SELECT * FROM dated WHERE "Year" = 1997)'


def _profit_by_category_1997() -> str:
    """Profit of 1997 and of the days a year before the days of 1997, 29 February 1996 with them."""
    shifted = (
        f"SELECT Before AS d FROM {IN_1997} UNION SELECT last_day(Before) FROM {IN_1997} "
        'WHERE month("Date") = 2 AND day("Date") IN (27, 28) AND day(last_day(Before)) = 29 '
        "GROUP BY last_day(Before) HAVING count(*) = 2"
    )
    past_days = f'SELECT d FROM ({shifted}) WHERE d IN (SELECT "Date" FROM days)'
    part = "SELECT CategoryName, sum(Profit) AS v FROM wide_sales WHERE OrderDate IN ({}) GROUP BY 1"
    now = part.format(f'SELECT "Date" FROM {IN_1997}')
    return (
        f"SELECT COALESCE(n.CategoryName, p.CategoryName) AS CategoryName, {_double('n.v', 'profit')}, "
        f"{_double('p.v', 'profit_ly')} FROM ({now}) n FULL JOIN ({part.format(past_days)}) p "
        "ON n.CategoryName IS NOT DISTINCT FROM p.CategoryName"
    )


def _far_measures() -> dict[str, str]:
    """Measures that repeat over the groups of a column that does not reach them."""
    back = "(SELECT CAST(sum(ReturnQuantity) AS BIGINT) FROM fact_returns)"
    lands = f"(SELECT {_distinct('Country')} FROM dim_territories)"
    quantity = "CAST(sum(OrderQuantity) AS BIGINT) AS total_quantity_sold"
    genders = "(SELECT DISTINCT Gender FROM dim_customers)"
    sold = f"(SELECT Gender, {quantity} FROM wide_sales GROUP BY 1)"
    returned = (
        "(SELECT CategoryName, CAST(sum(ReturnQuantity) AS BIGINT) AS q FROM wide_returns GROUP BY 1)"
    )
    years = 'SELECT DISTINCT "Year" FROM dim_date'
    return {
        "return_rate_by_gender": "SELECT COALESCE(g.Gender, s.Gender) AS Gender, s.total_quantity_sold, "
        f"{_ratio(back, 's.total_quantity_sold', 'return_rate')} FROM {genders} g FULL JOIN {sold} s "
        "ON g.Gender IS NOT DISTINCT FROM s.Gender",
        "total_countries_by_category": "SELECT DISTINCT CategoryName, "
        f"{lands} AS total_countries FROM dim_products",
        "countries_and_revenue_by_year": f'SELECT COALESCE(d."Year", s."Year") AS "Year", s.revenue, '
        f"{lands} AS total_countries FROM ({years}) d FULL JOIN "
        f'(SELECT "Year", {REVENUE} FROM wide_sales GROUP BY 1) s '
        'ON d."Year" IS NOT DISTINCT FROM s."Year"',
        "returns_by_category_and_gender": "SELECT s.*, r.q AS total_returned_quantity FROM "
        f"(SELECT CategoryName, Gender, {quantity} FROM wide_sales GROUP BY 1, 2) s "
        f"LEFT JOIN {returned} r ON s.CategoryName IS NOT DISTINCT FROM r.CategoryName",
    }


ASIA_1997 = "WHERE Country = 'Asia' AND \"Year\" = 1997"


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    for source in COLUMNS:
        names = _names(source)
        sql[f"clean_{source}"] = f"SELECT {names} FROM clean_{source}"
        sql[f"gate_{source}"] = f"SELECT {names} FROM bad_gate_{source}"
        sql[f"dedup_{source}"] = f"SELECT {names} FROM many_silver_{source}"
        sql[f"dq_report_{source}"] = _report(source, f"bad_clean_{source}")
        sql[f"dq_dup_{source}"] = (
            "SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(COALESCE(sum(n) "
            "FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows FROM "
            f"(SELECT count(*) AS n FROM bad_clean_{source} GROUP BY {KEYS[source]})"
        )
    sql |= {
        "dim_customers": "SELECT * FROM dim_customers",
        "dim_date": "SELECT * EXCLUDE (MonthName) FROM dim_date",
        "dim_products": _money("ProductPrice ProductCost", "dim_products"),
        "dim_territories": "SELECT * FROM dim_territories",
        "fact_sales": _money(FACT_COLUMNS, "fact_sales"),
        "fact_sales_spread": _money(FACT_COLUMNS, "fact_sales"),
        "fact_returns": "SELECT * FROM fact_returns",
        "revenue_by_region_map": _grouped(REVENUE, "Region, Country"),
        "revenue_profit_by_month": _grouped(f"{REVENUE}, {PROFIT}", '"Month", MonthName'),
        "revenue_by_category": _grouped(REVENUE, "CategoryName"),
        "orders_by_category": _grouped(
            f"{_distinct('OrderNumber')} AS total_orders", "CategoryName"
        ),
        "profit_by_category": _grouped(PROFIT, "CategoryName"),
        "return_rate_by_category": _return_rate(),
        "revenue_by_country": _grouped(REVENUE, "Country"),
        "revenue_by_region": _grouped(REVENUE, "Region"),
        "revenue_by_year": _grouped(REVENUE, '"Year"'),
        "revenue_by_occupation": _grouped(REVENUE, "Occupation"),
        "revenue_by_gender": _grouped(REVENUE, "Gender"),
        "revenue_by_gender_spread": _grouped(REVENUE, "Gender"),
        "orders_by_gender_spread": _grouped(f"{_distinct('OrderNumber')} AS total_orders", "Gender"),
        "revenue_by_category_and_country_spread": _grouped(REVENUE, "CategoryName, Country"),
        "return_amount_by_country": _grouped(AMOUNT, "Country", "wide_returns"),
        "top_customers_revenue": _top("sum(Revenue)", "revenue", "FullName", "wide_sales", 11),
        "top_products_revenue": _top("sum(Revenue)", "revenue", "ProductName", "wide_sales", 10),
        "top_products_returned": _top(
            "sum(ReturnQuantity)", "total_returned_quantity", "ProductName", "wide_returns", 10
        ).replace("CAST(m AS DOUBLE)", "CAST(m AS BIGINT)"),
        "kpi_revenue": f"SELECT {REVENUE} FROM fact_sales",
        "kpi_profit": f"SELECT {PROFIT} FROM fact_sales",
        "kpi_profit_margin": f"SELECT {_ratio('sum(Profit)', 'sum(Revenue)', 'profit_margin')} "
        "FROM fact_sales",
        "kpi_total_orders": f"SELECT {_distinct('OrderNumber')} AS total_orders FROM fact_sales",
        "kpi_total_quantity": "SELECT CAST(sum(OrderQuantity) AS BIGINT) AS total_quantity_sold "
        "FROM fact_sales",
        "kpi_return_rate": "SELECT "
        + _ratio(
            "(SELECT sum(ReturnQuantity) FROM fact_returns)",
            "(SELECT sum(OrderQuantity) FROM fact_sales)",
            "return_rate",
        ),
        "kpi_returned_quantity": "SELECT CAST(sum(ReturnQuantity) AS BIGINT) "
        "AS total_returned_quantity FROM fact_returns",
        "kpi_total_customers": f"SELECT {_distinct('CustomerKey')} AS total_customers "
        "FROM fact_sales",
        "kpi_avg_order_value": "SELECT "
        + _ratio("sum(Revenue)", _distinct("OrderNumber"), "avg_order_value")
        + " FROM fact_sales",
        "kpi_total_countries": f"SELECT {_distinct('Country')} AS total_countries "
        "FROM dim_territories",
        "kpi_total_regions": f"SELECT {_distinct('Region')} AS total_regions FROM dim_territories",
        "kpi_return_orders": f"SELECT {_distinct('ReturnKey')} AS total_return_orders "
        "FROM fact_returns",
        "kpi_return_amount": f"SELECT {AMOUNT} FROM wide_returns",
        "revenue_by_category_filtered": "SELECT g.CategoryName, s.revenue, s.total_orders, "
        f"g.return_rate FROM ({_return_rate(ASIA_1997, ASIA_1997)}) g LEFT JOIN "
        f"(SELECT CategoryName, {REVENUE}, {_distinct('OrderNumber')} AS total_orders "
        f"FROM wide_sales {ASIA_1997} GROUP BY 1) s "
        "ON g.CategoryName IS NOT DISTINCT FROM s.CategoryName",
        "revenue_ly_total": _last_year("Revenue", ""),
        "revenue_ly_by_year": _last_year("Revenue", '"Year"'),
        "revenue_ly_by_year_shift": _last_year("Revenue", '"Year"', month_ends=False),
        "revenue_yoy_by_month": _last_year("Revenue", '"Year", "Month"', growth=True),
        "profit_ly_by_year": _last_year("Profit", '"Year"'),
        "profit_yoy_by_month": _last_year("Profit", '"Year", "Month"', growth=True),
        "revenue_ly_filtered": _last_year("Revenue", "", chosen=IN_1997),
        "revenue_yoy_filtered": _last_year("Revenue", '"Month"', growth=True, chosen=IN_1997),
        "profit_ly_by_category_filtered": _profit_by_category_1997(),
        "clean_dates": f"SELECT o_orderkey, text, {_date('text')} AS day "
        f"FROM (SELECT o_orderkey, {DATE_TEXTS} AS text FROM orders)",
        "return_key": "SELECT ReturnKey, ReturnDate, TerritoryKey, ProductKey, "
        'count(*) AS "rows", CAST(sum(ReturnQuantity) AS BIGINT) AS quantity '
        "FROM bad_clean_returns GROUP BY ALL",
        "dq_verdict": "SELECT table_name, CAST(COALESCE(sum(failed_rows) FILTER "
        "(WHERE status = 'FAIL'), 0) AS BIGINT) AS critical_failures, "
        "CASE WHEN count(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END "
        "AS verdict FROM ("
        + " UNION ALL ".join(_report(s, f"bad_clean_{s}") for s in COLUMNS)
        + ") GROUP BY table_name",
        "dq_gate": "SELECT table_name, count(*) FILTER (WHERE status = 'FAIL') > 0 AS stopped "
        "FROM ("
        + " UNION ALL ".join(_report(s, f"silver_{s}") for s in COLUMNS)
        + ") GROUP BY table_name",
        "dq_audit_append": _report("sales", "bad_first_clean_sales")
        + " UNION ALL "
        + _report("sales", "bad_later_clean_sales"),
        "dq_audit_two_schemas": f"SELECT *, CAST(NULL AS BIGINT) AS checked_rows FROM ({_report('sales', 'bad_first_clean_sales')}) UNION ALL "
        f"SELECT *, (SELECT count(*) FROM bad_later_clean_sales) AS checked_rows FROM ({_report('sales', 'bad_later_clean_sales')})",
        "upsert_events": _merge(_events(EARLY), _events(LATE), "user_id"),
        "upsert_null_key": _merge(_events(EARLY, True), _events(LATE, True), "user_id"),
        "upsert_sales": _merge(
            "first_silver_sales", "later_silver_sales", "OrderNumber, OrderLineItem"
        ),
        "upsert_fact_sales": _money(
            FACT_COLUMNS,
            "("
            + _merge(
                f"({_fact('first_silver_sales')})",
                f"({_fact('later_silver_sales')})",
                "OrderNumber, OrderLineItem, ProductKey",
            )
            + ")",
        ),
        "upsert_keyed_table": _merge(
            "first_silver_sales", "later_silver_sales", "OrderNumber, OrderLineItem"
        ),
        "upsert_bootstrap": "SELECT * FROM silver_customers",
        "hwm_slice": "SELECT * FROM events "
        f"WHERE ts > (SELECT max(ts) FROM events WHERE {EARLY})",
        "gold_hwm": f"SELECT 1 AS load, TRUE AS from_epoch, max(ts) AS mark, count(*) AS \"rows\" "
        f"FROM events WHERE {EARLY} UNION ALL SELECT 2, FALSE, max(ts), count(*) FROM events "
        f"WHERE ts > (SELECT max(ts) FROM events WHERE {EARLY})",
        "bronze_ingest": "SELECT OrderDate, StockDate, OrderNumber, ProductKey, CustomerKey, "
        "TerritoryKey, OrderLineItem, OrderQuantity, TRUE AS from_landing, TRUE AS dated "
        "FROM raw_sales",
        "bronze_contract": "SELECT * FROM raw_customers",
        "silver_stream_upsert": STREAMED,
        "silver_stream_by_name": f"SELECT *, unnest(['keyed', 'history']) AS way FROM ({STREAMED})",
        "landing_ready": _landing("ready", "files", LANDED),
        "landing_fresh": _landing("fresh", "new_files", CHANGED),
        "lakehouse_refresh": _landed(),
        "lakehouse_incremental": _landed(
            STREAMED, "CASE WHEN s.CategoryName = 'Promo' THEN 'Promo Goods' ELSE s.CategoryName END"
        ),
        "lakehouse_gate": _gated(),
        "setup_namespaces": _layers(),
        "silver_batch_cuts": _cuts(),
        "date_spine": _spine(
            'SELECT year(min("Date")) AS lo, year(max("Date")) AS hi FROM dim_date'
        ),
        "date_hierarchy_orderdate": _hierarchy(
            "SELECT OrderDate AS d, Revenue AS r FROM fact_sales"
        ),
        "date_hierarchy_stockdate": _hierarchy(
            "SELECT StockDate AS d, Revenue AS r FROM fact_sales"
        ),
        "date_hierarchy_birthdate": _hierarchy(
            "SELECT c.BirthDate AS d, f.Revenue AS r FROM fact_sales f "
            "LEFT JOIN dim_customers c ON f.CustomerKey = c.CustomerKey"
        ),
        "orders_and_customers_by_category": _grouped(
            f"{_distinct('OrderNumber')} AS total_orders, {_distinct('CustomerKey')} AS total_customers", "CategoryName"
        ),
        "kpi_orders_customers_quantity": "SELECT CAST(sum(OrderQuantity) AS BIGINT) AS total_quantity_sold, "
        f"{_distinct('OrderNumber')} AS total_orders, {_distinct('CustomerKey')} AS total_customers FROM fact_sales",
        "implicit_by_country_filtered": "SELECT COALESCE(s.Country, r.Country) AS Country, s.* EXCLUDE (Country), r.* EXCLUDE (Country) "
        "FROM (SELECT Country, CAST(sum(OrderQuantity) AS BIGINT) AS sum_of_sales_orderquantity, count(*) AS rows_of_sales "
        'FROM wide_sales WHERE "Year" = 1997 GROUP BY 1) s FULL JOIN '
        "(SELECT Country, CAST(sum(ReturnQuantity) AS BIGINT) AS sum_of_returns_returnquantity, count(*) AS rows_of_returns "
        'FROM wide_returns WHERE "Year" = 1997 GROUP BY 1) r ON s.Country IS NOT DISTINCT FROM r.Country',
        "implicit_by_category": "SELECT COALESCE(p.CategoryName, s.CategoryName) AS CategoryName, p.a AS sum_of_products_productprice, "
        "p.n AS count_of_products_productsubcategorykey, s.q AS sum_of_sales_orderlineitem FROM "
        "(SELECT CategoryName, CAST(sum(ProductPrice) AS DOUBLE) AS a, count(ProductSubcategoryKey) AS n FROM dim_products GROUP BY 1) p "
        "FULL JOIN (SELECT CategoryName, CAST(sum(OrderLineItem) AS BIGINT) AS q FROM wide_sales GROUP BY 1) s "
        "ON p.CategoryName IS NOT DISTINCT FROM s.CategoryName",
        "implicit_sum_quantity": "SELECT CAST(sum(OrderQuantity) AS BIGINT) AS quantity "
        "FROM fact_sales",
        "implicit_count_category": "SELECT ProductColor, count(ProductCategoryKey) AS categories "
        "FROM dim_products GROUP BY ProductColor",
    }
    sql |= _far_measures() | _drills()
    for name in STORED:
        sql[f"stored_{name}"] = re.sub(r"\b(wide|fact)_(sales|returns)\b", r"landed_\1_\2", sql[name])
    return {name: _with(text) for name, text in sql.items()}
