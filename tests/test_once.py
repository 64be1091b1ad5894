"""Values that many rules use are computed once a row, and rules' code stays short enough to be compiled."""

import pytest
from pyspark.sql import functions as F

from prediolake import fixed
from prediolake.functions import normalize
from prediolake.functions.text import SPACES, ascii_digits, digits, look_up, strip, text, title, whole
from prediolake.functions.validate import sanitized
from prediolake.plans.queries import QUERIES
from prediolake.schemas import LISTING
from prediolake.sources.files import csv_line

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("name", "part", "most"), [("card_line_state", "En Arriendo", 1), ("card_rule_chain", "gratis", 1), ("alternating_pairs", "Precio\n", 1), ("flagged_preview", "initcap(", 2), ("csv_lines", "\"\"", 1)])
def test_computed_once(spark, name, part, most):
    before = spark.conf.get("spark.sql.maxPlanStringLength")
    spark.conf.set("spark.sql.maxPlanStringLength", str(1 << 24))
    try:
        assert 1 <= QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString().count(part) <= most
    finally:
        spark.conf.set("spark.sql.maxPlanStringLength", before)


def test_strip_is_that_of_the_pattern(spark):
    texts = ["", " ", "a", " a b\n", "\xa0　", "\x1ca\x1c", "​a ", "\u0085x ", *(c + "x" + c for c in SPACES), *(chr(k) + "y" + chr(k) for k in range(0x2000, 0x2070))]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert rows.filter(~strip(F.col("t")).eqNullSafe(F.regexp_replace("t", r"(?U)^\s+|\s+$", ""))).collect() == []


def test_what_is_shuffled_for_picked_rows_has_no_texts(spark):
    """Six numbers a row; before, some 17 columns with the raw texts, and the order twice."""
    plan = QUERIES["dedupe_last"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    picked = next(line for line in plan.splitlines() if "Aggregate [" in line)
    assert "max(struct(" in picked and "max_by" not in plan and "p_name" not in picked and "raw_" not in picked


@pytest.mark.parametrize("name", ["csv_lines", "dedupe_first", "dedupe_last", "export_filter", "export_values", "extension_top_prices"])
def test_small_sides_are_broadcast(spark, name):
    """Suppliers with their nations and regions were taken for the product of the three, and all line items shuffled to meet them."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_what_is_sorted_is_made_once(spark):
    """A sort samples what it sorts: joins, normalizers and rules came before it, and ran twice."""
    plan = QUERIES["exportable_listings"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [" in plan and "Join" not in plan and "regexp" not in plan


def test_what_is_filtered_is_made_once(spark):
    """The filter of prices and types was pushed below the normalizers, with a copy of them in it."""
    plan = QUERIES["export_filter"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter " in line]
    assert filters and not any("regexp_replace" in line for line in filters)


def test_lines_are_made_without_functions_over_arrays(spark):
    """Those aren't compiled; each cell of each line was trimmed and looked up in one. Prices were split up to six times."""
    plan = QUERIES["csv_lines"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    line = plan.split("+- Project")[0]
    assert "CASE WHEN Contains(concat(" in line and line.index("CASE WHEN Contains(concat(") < line.index("transform(") and "trim(" not in line and "stringsplitsql" not in plan


SIGNS = ["", " ", "a", "B c", "N/A", " null\n", "null x", "nan", "　NA\x85", "-1", " -1", "-12", "n", "None\x0b", "\x00none", 'q"q', '"', '""', "é ", "ñandú", " n/a ", "Nilo", "x\x01 y", "\x01\x02a-b\x01", "ab-cd e1f", "ⅷ ⅷⅷ aⅷ 1 ⅷ", "ΟΔΟΣ ΑΣ-ΣΑΣ",
         "ǆep-ǆ ǆ", "ßa-ß", "İz-İ", "barrio: Los-Altos", " BARRIO:　 - X", "Barrio:", "a - ", " - a,", "a, b - c,\x85d e", "Apto", "casa-lote", "- casa", " - ", "x- Casa", "III", " iv ", "8", "08", "٨", "7", "007", "4.5", "+4", "99999999999", "8x", "$ 1.234 / $ 9", "/5", "٣٤ / 9", "9223372036854775807",
         "92233720368547758080", "Consultar Precio", "//a/b", " /x ", "/"]


def test_forms_made_once_are_those_before(spark):
    """The rules as they were written before, on odd texts."""
    rows = spark.createDataFrame([(t,) for t in [None, *SIGNS, *(c + "null" + c for c in SPACES), *(c + "8" + c for c in SPACES), *(f"barrio:{c}x{c}" for c in SPACES)]], "t string")
    t, s = text("t"), strip(text("t"))
    low = F.lower(s)
    titled = lambda c: F.array_join(F.transform(F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1), F.initcap), "")
    level = F.coalesce(look_up(fixed.ROMAN, low), F.when(low.rlike("^[0-9]+$"), whole(low)), F.lit(0))
    first = strip(F.split_part(low, F.lit("-"), F.lit(1)))
    place = F.substring_index(strip(F.regexp_replace(s, r"(?i)^barrio:", "")), " - ", -1)
    path = F.concat(F.lit("https://e.co/"), F.regexp_replace(s, "^/+", ""))
    for now, then in (
        (title(t), titled(t)),
        (normalize.estrato(F.col("t")), F.when(level == 8, 0).otherwise(level)),
        (normalize.tipo(F.col("t")), F.when(low == "", "").otherwise(F.coalesce(look_up(fixed.TIPO, low), F.when(low.contains("-"), look_up(fixed.TIPO, first, first)), low))),
        (normalize.barrio(F.col("t")), strip(titled(strip(F.substring_index(place, ",", -1))))),
        (normalize.price(F.col("t")), F.when(F.lower(t).contains("consultar precio"), F.lit(0)).otherwise(whole(digits(ascii_digits(F.split_part(t, F.lit("/"), F.lit(1)))), "bigint"))),
        (normalize.url(F.col("t"), "https://e.co/"), F.when(s.startswith("/"), path).otherwise(s)),
        (sanitized("t", False), F.when(s.isin(*fixed.MARKERS), "").otherwise(t)),
    ):
        assert rows.select("t", now.alias("now"), then.alias("then")).filter("not (now <=> then)").collect() == []


def test_csv_lines_of_odd_listings(spark):
    odd = [None, "a", 'q"q', ' "', "null", " N/A　", "n", "-1", ""]
    numbers = [None, -1, 0, 7, -5]
    given = [(odd[k % 9], "p", odd[(k // 2) % 9], *(numbers[(k + n) % 5] for n in range(6)), odd[(k // 3) % 9], odd[(k // 5) % 9]) for k in range(90)]
    told = lambda x: '"' + ("" if x is None or x.strip() in fixed.MARKERS else x).replace('"', '""') + '"' if isinstance(x, str) or x is None else x
    want = [",".join(str(0 if x in (None, -1) else x) if 3 <= k < 9 else told(x) for k, x in enumerate(r)) for r in given]
    rows = spark.createDataFrame([(k, *r) for k, r in enumerate(given)], "k int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LISTING))
    assert [r[0] for r in rows.orderBy("k").select(csv_line()).collect()] == want
    texts = spark.createDataFrame([("i", "p", "t", "12.0", " 12 ", None, "null", "+3", "-1", "b", "u")], ", ".join(f"{f.name} string" for f in LISTING))
    assert texts.select(csv_line()).collect()[0][0] == '"i","p","t",0,12,0,0,3,0,"b","u"'
