import datetime

import pytest
from pyspark.sql import functions as F

from gristmill.functions import casting, measures, nested, text
from tests.conftest import rows


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def applied(spark, values, function, kind="string"):
    out = column(spark, values, kind).select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in out]


def test_to_number_rejects_what_a_cast_accepts(spark):
    values = ["12", " 12.5 ", "-1e3", ".5", "5.", "+7", "12d", "12f", "0x1p3", "nan", "NaN", "", " ", "abc", "1 2", None, " 8"]
    got = applied(spark, values, casting.to_number)
    assert got == [12.0, 12.5, -1000.0, 0.5, 5.0, 7.0] + [None] * 10 + [8.0]
    assert applied(spark, ["inf", "-Infinity", "+INF"], casting.to_number) == [float("inf"), float("-inf"), float("inf")]


def test_to_whole_truncates_toward_zero_and_swallows_infinity(spark):
    values = ["12.7", "-12.7", "1_000", "\t3\n", "inf", "1e30", "x", None, ""]
    assert applied(spark, values, casting.to_whole) == [12, -12, 1000, 3, None, None, None, None, None]


def test_to_flag_missing_is_false(spark):
    values = ["true", "1", " T ", "YES", "y", "no", "", None, "2"]
    assert applied(spark, values, casting.to_flag) == [True] * 5 + [False] * 4


def test_to_day_wants_the_whole_shape(spark):
    values = ["1995-10-30", "1995-1-3", "1", "1995", "1995-02-30", "1995-10-30x", None]
    day = datetime.date
    assert applied(spark, values, casting.to_day) == [day(1995, 10, 30), day(1995, 1, 3)] + [None] * 5


def test_to_id_is_strict(spark):
    assert applied(spark, [862.0], casting.to_id, "double") == [862]
    with pytest.raises(Exception):
        applied(spark, ["a"], casting.to_id)


def test_text_helpers(spark):
    assert applied(spark, ["  The CROWN ", None], text.join_key) == ["the crown", None]
    assert applied(spark, ["TV Dramas, Intl", "", " ,x", None], text.first_item) == ["TV Dramas", None, None, None]
    assert applied(spark, ["a, b ,,c", ""], text.list_items) == [["a", "b", "c"], []]
    assert applied(spark, ["nan", "x", None], text.sentinel_to_null) == [None, "x", None]
    kept = column(spark, ["ok", "b�d", "ÿ", "ã", None]).where(text.is_intact(F.col("v"), text.DAMAGE_MARKS))
    assert rows(kept, "v") == [("ok",)]


def test_measures(spark):
    assert applied(spark, [1995, 2000, -1, None], measures.floor_to_ten, "int") == [1990, 2000, -10, None]
    seasons = applied(spark, [f"2024-{m:02d}-01" for m in (2, 3, 5, 6, 8, 9, 11, 12)], lambda c: measures.season_of(c.cast("date")))
    assert seasons == ["winter", "spring", "spring", "summer", "summer", "fall", "fall", "winter"]
    assert applied(spark, ["spring", "winter", "monsoon", None], measures.season_order) == [1, 4, None, None]
    assert applied(spark, [1, 0, None], lambda c: measures.two_way_label(c == 1, "yes", "no"), "int") == ["yes", "no", "no"]
    assert applied(spark, [0.0, 2.0, -1.0, None], lambda c: measures.guarded_ratio(F.lit(10.0), c), "double") == [None, 5.0, None, None]
    bucketed = lambda c: measures.bucket([(c <= 3, "top_3"), (c <= 7, "rank_4_7")], "rank_8_10")
    assert applied(spark, [3, 4, 7, 8], bucketed, "int") == ["top_3", "rank_4_7", "rank_4_7", "rank_8_10"]


FIELDS = {"id": "bigint", "name": "string"}


def test_literal_items(spark):
    cells = [
        "[{'id': 11, 'name': 'harbour'}, {'id': 1200, 'name': 'violin'}]",
        "[{'id': 1, 'name': \"violin's\"}]",
        "[{'id': 1, 'name': None}]",
        "[5, {'id': 2, 'name': 'b'}]",
        "[]", None, "broken", "{'id': 1}", "[null]", "[{'id': true}]", "[NaN]",
        r"[{'id': 3, 'name': 'it\'s é'}]",
        "[{'id': '7', 'name': 12}]",
        "[{'id': None, 'name': 'say \"hi\"'}]",
        "[{'id': True, 'name': 'None', 'other': (1, 2)}]",
        "[{'name': 'a' 'b'}]",
    ]
    got = applied(spark, cells, lambda c: nested.literal_items(c, FIELDS))
    got = [[tuple(item) for item in cell] for cell in got]
    assert got == [
        [(11, "harbour"), (1200, "violin")], [(1, "violin's")], [(1, None)], [(None, None), (2, "b")],
        [], [], [], [], [], [], [],
        [(3, "it's é")], [(7, "12")], [(None, 'say "hi"')], [(1, "None")], [(None, "ab")],
    ]


@pytest.mark.parametrize("cell", ["[{'id': 'x'}]", "[{'id': 99999999999999999999}]"])
def test_item_ids_are_strict(spark, cell):
    with pytest.raises(Exception, match="x|64 bits"):
        applied(spark, [cell], lambda c: nested.literal_items(c, FIELDS))


def test_first_name_never_looks_past_the_first_item(spark):
    cells = ["[{'name': 'a'}, {'name': 'b'}]", "[5, {'name': 'b'}]", "[]", None, "[{'x': 1}]"]
    got = applied(spark, cells, lambda c: nested.first_name(nested.literal_items(c, {"name": "string"})))
    assert got == ["a", None, None, None, None]


def test_literal_items_round_trip(spark):
    import random

    random.seed(5)
    names = ["a", "it's", 'say "x"', "back\\slash", "tab\t", "é�", "None", "[x]", "", "new\nline", "l'a \"b\""]
    items = [[{"id": random.randint(-9, 9), "name": random.choice(names)} for _ in range(random.randint(0, 4))] for _ in range(200)]
    got = applied(spark, [repr(i) for i in items], lambda c: nested.literal_items(c, FIELDS))
    assert [[{"id": x["id"], "name": x["name"]} for x in cell] for cell in got] == items


PLAIN = [
    "[]", "[ ]", "[{}]", "[{'id': 1, 'name': 'a'}]", '[{"name": "it\'s", \'id\': -12}]', "[5, None, {'id': None}, 'x']",
    "[{'name': 'say \"hi\"'}, {'name': 7}]", "[\n{'name' :'é', 'other': 0}\t]",
]
NOT_PLAIN = [
    "[{'id': '7'}]", "[{'id': True}]", r"[{'name': 'it\'s'}]", "[{'name': 'a' 'b'}]", "[{'name': 1.5}]", "[(1, 2)]", "[[1]]", "[1,]",
    "[{'id': 007}]", "[{'id': 1}]]", "[{'id': 1}], [{'id': 2}]", "[{'id': 1}] x", "[null]", "[{'name': 'tab\there'}]", " [1]", "[-0]",
    "[{'id': 9999999999999999999}]", "[Nonesuch]", "{'id': 1}", "broken", "",
]


def test_plain_cells_are_told_apart(spark):
    kinds = {"id": "bigint", "name": "string"}
    got = applied(spark, PLAIN + NOT_PLAIN, lambda c: nested._plain(c, kinds))
    assert got == [True] * len(PLAIN) + [False] * len(NOT_PLAIN)
    # a text is allowed where the field is a text as well
    assert applied(spark, ["[{'id': '7'}]"], lambda c: nested._plain(c, {"id": "string"})) == [True]


def test_plain_cells_read_as_the_literal_parser_reads_them(spark):
    import ast
    import random

    random.seed(8)
    items = [
        "{'id': 4, 'name': None}", "{'name': \"o'k\", 'id': 9}", "5", "None", "'s'", "{}", "{'id': 2, 'id': 3}", "{ 'id':-12 ,'name':'q\"q' }",
        "{'name': ''}", "{'name': '}, 5'}", "{'name': '[{'}", "{'name': 7}", "{'NAME': 'x'}",
    ]
    cells = ["[" + " , ".join(random.choice(items) for _ in range(random.randint(0, 5))) + "]" for _ in range(300)]
    cells.append("[" + ", ".join("{'id': %d, 'name': 'n'}" % i for i in range(30_000)) + "]")
    kinds = {"id": "bigint", "name": "string"}
    assert all(applied(spark, cells, lambda c: nested._plain(c, kinds)))
    got = applied(spark, cells, lambda c: nested.literal_items(c, kinds))

    def expected(item):
        item = item if isinstance(item, dict) else {}
        name = item.get("name")
        return item.get("id"), name if name is None else str(name)

    assert [[tuple(item) for item in cell] for cell in got] == [[expected(i) for i in ast.literal_eval(cell)] for cell in cells]
