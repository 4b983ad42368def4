import pytest

from millrace.models.pages import Kinds, Records

KINDS = Kinds(("sword",), ("beast",))
GOOD = """<title>Old &amp; Sharp</title><h2>basic data</h2><table><tr><th>rarity<td>ur<tr><th>gear type<td>sword<tr><th>gear cost<td>1,050<tr><th>infusion count<td>4</table>
<h2>stats</h2><table><tr><th>attack<td>+initial<td>1,200<tr><th>attack<td>+max<td>2,400</table><h2>skill</h2><table><tr><th>Flash<td>target: foe . cuts<br>power scales with level<br>[activation rate]<br>15%</table>
<h2>weapon ability</h2><table><tr><th>Edge<td><a href='/item/ab9'>boosts</a></table><h2>reforge</h2><table><tr><th>before reforge<td><a href='/item/77'>Dull</a><tr><th>reforge gear material<td><a href='/item/5'>Iron</a><td>3<tr><th>reforge item material<td>Oil<td></table>"""
BEAST = """<title>Bear</title><h2>basic data</h2><table><tr><th>gear type<td>beast<tr><th>element<td>red</table><h2>skill</h2><table><tr><th>Roar<td>roars</table><h2>skill 2</h2><table><tr><th>Bite<td>target: all . bites<br>again</table>
<h2>passive skill</h2><table><tr><th>Fur<td>warms</table><h2>hidden potential</h2><table><tr><th>lv 20<td>grows<tr><th>lv 5<td>target: self . wakes<tr><th>restrictions<td>bears only</table>
<h2>special evolution</h2><table><tr><th>before enlightening<td>Cub<tr><th>enlightening item material<td><a href='/item/h1'>Honey</a><td>2<tr><th>before awakening<td><a href='/other/1'>Cub</a></table>"""


@pytest.fixture
def read(spark, tmp_path):
    def make(*pages):
        return Records(spark.createDataFrame(pages, "page_id long, html string"), f"{tmp_path}/pages", KINDS, ("red", "none"))

    return make


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_a_weapon(read):
    t = read((1, GOOD))
    assert rows(t["equipment"]) == [(1, "Old & Sharp", "weapon", "ur", "sword", 1050, "none", 0)]
    assert rows(t["weapon"]) == [(1, 4)] and rows(t["defensive_gear"]) == rows(t["monster"]) == []
    assert rows(t["stat"]) == [(1, "attack", "initial", 1200), (1, "attack", "max", 2400)]
    assert rows(t["proc"]) == [(1, "Flash", "15%")] and rows(t["weapon_ability"]) == [(1, "ab9", "Edge")]
    assert rows(t["skill_effect"]) == [(1, "proc", 1, 1, "foe", "cuts"), (1, "weapon_ability", 1, 1, None, "boosts")]
    assert rows(t["evolution"]) == [(1, "reforge", "77", "Dull")]
    assert rows(t["evolution_material"]) == [(1, "reforge", 1, "gear", "5", "Iron", 3), (1, "reforge", 2, "item", None, "Oil", 1)]
    assert rows(t["element"]) == [("none",), ("red",)] and rows(t.errors()) == []


def test_a_monster(read):
    t = read((2, BEAST))
    assert rows(t["monster"]) == [(2, "bears only")] and rows(t["passive_skill"]) == [(2, "Fur")] and rows(t["proc"]) == []
    assert rows(t["monster_skill"]) == [(2, 1, "Roar"), (2, 2, "Bite")]
    assert rows(t["skill_effect"]) == [(2, "monster_skill", 1, 1, None, "roars"), (2, "monster_skill", 2, 1, "all", "bites"), (2, "monster_skill", 2, 2, None, "again"), (2, "passive_skill", 1, 1, None, "warms")]
    assert rows(t["potential_level"]) == [(2, 20, None, "grows"), (2, 5, "self", "wakes")]
    assert rows(t["evolution"]) == [(2, "awakening", None, "Cub"), (2, "enlightening", None, "Cub")]
    assert rows(t["evolution_material"]) == [(2, "enlightening", 1, "item", "h1", "Honey", 2)]


def test_bad_pages_give_an_error_and_no_record(read):
    shield = "<title>S</title><h2>basic data</h2><table><tr><th>gear type<td>shield</table>"
    t = read(
        (1, GOOD), (2, None), (3, "<p>no title"), (4, "<title>t</title>"), (5, GOOD.replace("+max", "+initial")), (6, GOOD.replace("Sharp", "Sh\x1farp")),
        (7, GOOD.replace("<tr><th>reforge gear", "<tr><th>before reforge<td>Other<tr><th>reforge gear")), (8, GOOD), (8, BEAST), (9, BEAST), (9, None), (10, shield), (11, BEAST.replace("lv 20", "lv 5")),
    )
    assert dict(rows(t.errors())) == {
        2: """TypeError: can only concatenate str (not "NoneType") to str""", 3: "ValueError: no title", 4: "no gear type", 5: "a repeated key",
        6: "a control separator in a field", 7: "two slots: before reforge", 8: "a repeated id", 9: "a repeated id", 11: "a repeated key",
    }
    assert len(rows(t.errors())) == 11  # a row for each of the pages that share an id
    assert rows(t["equipment"].select("uid", "model_class")) == [(1, "weapon"), (10, "defensive_gear")]
    assert {r[0] for name in ("stat", "skill_effect", "evolution", "monster_skill") for r in rows(t[name].select("uid"))} == {1}
    assert {r.page_id for r in t.tagged().collect()} == {1, 10}


def test_no_pages(read):
    t = read()
    assert rows(t["equipment"]) == rows(t.errors()) == rows(t.tagged()) == []


def test_pages_are_parsed_once(read):
    t = read((1, GOOD), (2, BEAST))
    for name in ("equipment", "stat", "skill_effect", "evolution_material"):
        plan = t[name]._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in plan and "parquet" in plan.lower()
