"""Whole jobs on invented pages that the rendered ones do not cover."""

from pyspark.sql import functions as F

from folioweave.plans import dex, edges, learnsets, moves
from folioweave.plans import dex_values as DV
from folioweave.plans import edge_values as EV
from folioweave.sources import pages as S

C = F.col


def pages_of(spark, *rows):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], S.PAGE_SCHEMA)


def evo_row(a, b, text="", level="", fa="", fb=""):
    def cell(k, f):
        small = f'<small class="text-muted">{f}</small>' if f else ""
        return f'<td class="cell-name"><a title="View Pokedex for #{k} X">X</a><br>{small}</td>'
    return f'<tr>{cell(a, fa)}<td class="cell-num">{level}</td>{cell(b, fb)}<td class="cell-med-text">{text}</td></tr>'


def evo_page(method, *rows):
    return f"https://x.example.org/evolution/{method}", "<table><tbody>" + "".join(rows) + "</tbody></table>"


def test_edges_generation_two(spark):
    pages = pages_of(
        spark,
        evo_page("level", evo_row("0001", "0002", level="16"), evo_row("0133", "0196", "", level=""), evo_row("0236", "0106", "Attack &gt; Defense", "20"),
                 evo_row("0252", "0253", level="16"), evo_row("0019", "0020", "Nighttime", "20", "Alolan Rattata", "Alolan Raticate")),
        evo_page("friendship", evo_row("0133", "0196", "Daytime"), evo_row("0042", "0169")),
        evo_page("stone", evo_row("0025", "0026", "Thunder Stone, outside Alola")),
        evo_page("trade", evo_row("0061", "0186", "Kings Rock")),
        ("https://x.example.org/other", "<table><tbody>" + evo_row("0001", "0003") + "</tbody></table>"),
    )
    table, bad = edges.evolutions(pages, 2)
    assert [r.errors for r in bad.collect()] == [["method: unknown"]]
    got = {(r.evolves_from, r.evolves_to): r.asDict() for r in table.collect()}
    assert set(got) == {("0001", "0002"), ("0133", "0196"), ("0236", "0106"), ("0042", "0169"), ("0025", "0026"), ("0061", "0186")}
    # the same edge on two method pages: the level page ranks first, so its row stays
    assert got["0133", "0196"]["method"] == "level" and got["0133", "0196"]["stat"] is None
    assert got["0042", "0169"]["method"] == "level" and got["0042", "0169"]["stat"] == "Friendship"
    assert got["0236", "0106"]["stat"] == "Attack > Defense" and got["0236", "0106"]["level"] == 20.0
    assert got["0025", "0026"]["item_used"] == "Thunder Stone" and got["0025", "0026"]["method"] == "item"
    assert got["0061", "0186"]["item_held"] == "King's Rock"
    # nothing has a time of day left, so the column goes
    assert "time_of_day" not in got["0001", "0002"]


def test_edges_are_sorted_by_first_ranks(spark):
    pages = pages_of(spark, evo_page("stone", evo_row("0133", "0134", "Water Stone"), evo_row("0133", "0135", "Thunder Stone")),
                     evo_page("level", evo_row("0010", "0011", level="7")))
    got = [(r.evolves_from, r.evolves_to) for r in edges.evolutions(pages, 1)[0].collect()]
    assert got == [("0010", "0011"), ("0133", "0134"), ("0133", "0135")]


def test_edges_without_keys_are_quarantined(spark):
    broken = evo_row("0010", "0011").replace('<a title="View Pokedex for #0011 X">', "<a>")
    header = "<tr><th>From</th><th>To</th></tr>"
    pages = pages_of(spark, evo_page("level", header, evo_row("0001", "0002"), broken, "<tr><td>x</td></tr>"))
    good, bad = edges.evolutions(pages, 1)
    assert [r.evolves_to for r in good.collect()] == ["0002"]
    assert sorted(r.errors for r in bad.collect()) == [["evolves_from: missing", "evolves_to: missing"], ["evolves_to: missing"]]


def test_unknown_version_is_quarantined(spark, monkeypatch):
    pages = pages_of(spark, evo_page("level", evo_row("0001", "0002")), evo_page("stone", evo_row("0133", "0134")))
    monkeypatch.setitem(EV.GAMES, 9, ["Scarlet", "Violet"])
    good, bad = edges.evolutions(pages, 9)
    assert ["versions: unknown"] in [r.errors for r in bad.collect()]


def test_first_of_two_tables_on_a_page_wins(spark):
    two = "<table>" + evo_row("0001", "0002", level="16") + "</table><table>" + evo_row("0001", "0002", level="18") + "</table>"
    good, _ = edges.evolutions(pages_of(spark, ("https://x.example.org/evolution/level", two)), 1)
    assert [r.level for r in good.collect()] == [16.0]


def test_all_tables_with_a_caption_count(spark):
    def section(caption, name, value="5"):
        return (f"<table><tr><td><b>{caption}</b></td></tr><tr><td>h</td></tr><tr><td class='fooinfo'>{value}</td>"
                f"<td class='fooinfo'><a>{name}</a></td></tr><tr><td>text</td></tr></table>")
    head = "<table><tr>" + "<td>x</td>" * 11 + "<td>#0001</td></tr></table>"
    body = (head + section("Generation II Level Up", "Tackle") + section("TM & HM Attacks", "Cut", "HM01")
            + section("Generation II Level Up", "Growl", "7") + section("Egg Moves", "Bite") + section("Egg Moves (more)", "Charm"))
    good, bad = learnsets.learnsets(pages_of(spark, ("u", body)), 2)
    assert bad.count() == 0
    assert {(r.move, r.level_raw, r.egg_moves) for r in good.collect()} == {
        ("Tackle", "5", None), ("Growl", "7", None), ("Cut", None, None), ("Bite", None, "Egg"), ("Charm", None, "Egg")}


def move_page(power="40", rate="10 %"):
    def t(label, *cells, cls="cen"):
        return f"<table><tr><td>{label}</td></tr><tr>{''.join(f'<td class={chr(34)}{cls}{chr(34)}>{c}</td>' for c in cells)}</tr></table>"
    head = ["Spark", '<img src="/pokedex-bw/type/electric.gif">', '<img src="/pokedex-bw/type/special.png">', "20", power, "100"]
    flags = ["Physical Contact", "Sound-Type", "Punch Move", "Biting Move", "Affected by Gravity", "Defrosts When Used?", "Reflected By",
             "Blocked by", "Copyable by"]
    body = t("", *head) + t("", "effect text", cls="fooinfo") + t("", "Battle Effect:", "In-Depth Effect:", cls="fooleft")
    body += t("Secondary Effect:", "may shock", cls="fooinfo") + t("Effect Rate:", rate)
    body += t("<b>Base Critical Hit Rate</b></td><td><b>Speed Priority</b></td><td><b>Pokémon Hit in Battle</b>", "4.17%", "0", "Selected")
    for f in flags:
        body += t(f + "<br>x", "No1", "No2", "No3", "No4", "No5")
    return "https://x.example.org/attack/spark", body


def test_moves_generation_eight(spark):
    pages = pages_of(spark, move_page(), move_page(power="??"), ("u", "<p>gone</p>"), move_page(rate="--"))
    good, bad = moves.moves(pages, 8)
    rows = {r.page_id: r.asDict() for r in good.collect()}
    assert set(rows) == {0, 3}
    assert rows[0]["move_name"] == "Spark" and rows[0]["battle_type"] == "Electric" and rows[0]["category"] == "Special"
    assert (rows[0]["power_points"], rows[0]["base_power"], rows[0]["effect_rate"], rows[0]["further_info"]) == (20, 40, 10, "Yes")
    assert rows[0]["biting move"] == "No4" and rows[0]["snatchable"] == "No5" and rows[0]["speed_priority"] == "0"
    assert rows[3]["effect_rate"] is None and rows[3]["effect_rate_raw"] == "—"
    (odd,) = moves.moves(pages_of(spark, move_page(rate="30%")), 8)[0].collect()
    assert (odd.effect_rate, odd.effect_rate_raw) == (None, "30%")
    reasons = {r.page_id: r.errors for r in bad.collect()}
    assert reasons[1] == ["base_power: not a number"] and "move_name: missing" in reasons[2]


def dex_page(gen, types, stats, alternates="", evs="1 HP<br>", height="1'00\"", weight="2.0lbs", gender=None, name="Thing", rate="45",
             tail="", key="0001"):
    head = "h2" if gen >= 7 else "b"
    gender = gender or "<table><tr><td>M</td><td>50%</td></tr><tr><td>F</td><td>50%</td></tr></table>"
    def row(*cells):
        return "<tr>" + "".join(f"<td class='fooinfo'>{c}</td>" for c in cells) + "</tr>"
    extra = DV.EXTRA[gen][1] if gen in DV.EXTRA else "x"
    body = f"<table><tr><td><b>National</b></td><td>#{key}</td></tr></table><table class='dextable'>"
    body += row("Name", "Other", "No", "Gender Ratio", "Type") + row(name, "o", "n", gender, types)
    body += row("Classification", "Height", "Weight", "Capture Rate", "Base Egg Steps") + row("Seed Pokémon", height, weight, rate, "5,120") + "</table>"
    body += "<table><tr><td><b>Abilities</b>: <b>One</b> - <b>Two</b></td></tr></table>"
    body += "<table>" + row("Experience Growth", "x", "Effort Values Earned", extra) + row("1<br>Fast", "x", evs, "x can Dynamax") + "</table>"
    body += "<table>" + row("Egg Groups") + row("x", "<a>Plant</a>") + "</table>"
    body += "<table>" + row("Alternate Forms") + f"<tr>{alternates}</tr></table>"
    for s in stats:
        body += (f"<table class='dextable'><tr><td class='fooevo'><{head}>Stats</{head}></td></tr>"
                 + row("Base Stats", *[str(s + k) for k in range(6)]) + "</table>")
    return f"https://x.example.org/{gen}", body + tail


ICON = "<img src='/pokedex-bw/type/{}.gif'>"
FIRE, ICE = ICON.format("fire"), ICON.format("ice")


def nested(*rows):
    return "<table>" + "".join(f"<tr><td width='50%'>{f}</td><td>{i}</td></tr>" for f, i in rows) + "</table>"


def result(spark, gen, *pages):
    good, bad = dex.dex(pages_of(spark, *pages), gen)
    assert bad.count() == 0, bad.collect()
    return [r.asDict() for r in good.collect()]


def test_regional_forms_share_the_key(spark):
    page = dex_page(8, nested(("Normal", FIRE), ("Galarian", ICE)), [10, 50], "<td><b>Kantonian Form</b></td><td><b>Galarian Form</b></td>",
                    evs="1 HP<br><b>Galarian Form</b><br>2 Speed<br>", key="0052")
    rows = result(spark, 8, page)
    assert [(r["dex_no"], r["form"], r["type_one"], r["base_hp"], r["hp_evs"], r["speed_evs"]) for r in rows] == [
        ("0052", "Normal", "Fire", 10, 1, 0), ("0052g", "Galarian Form", "Ice", 50, 0, 2)]
    assert rows[0]["dynamax"] == "Yes"


def test_two_modes_of_a_named_page(spark):
    types = nested(("Normal", FIRE), ("Zen Mode", FIRE + ICON.format("psychic")), ("Galarian", ICE), ("Zen Mode", ICE + FIRE))
    page = dex_page(8, types, [10, 20, 30, 40], "<td><b>x</b></td>", name="Darmanitan", key="0555",
                    evs="<b>Standard</b><br>1 HP<br><b>Zen Mode</b><br>2 HP<br><b>Galarian Form</b><br>3 HP<br>")
    rows = result(spark, 8, page)
    assert [(r["dex_no"], r["type_one"], r["type_two"], r["base_hp"], r["hp_evs"]) for r in rows] == [
        ("0555", "Fire", "", 10, 1), ("0555ze", "Fire", "Psychic", 20, 2), ("0555g", "Ice", "", 30, 3), ("0555g-ze", "Ice", "Fire", 40, 2)]


def test_catch_rate_per_form(spark):
    page = dex_page(8, FIRE, [10, 20], "<td><b>x</b></td>", name="Minior", rate="30 (Meteor)<br>255 (Core)")
    rows = result(spark, 8, page)
    assert [(r["form"], r["cptr_rt"]) for r in rows] == [("Meteor Form", 30), ("Core Form", 255)]


def test_nested_standard_size(spark):
    def small(v):
        return f"\r\n\t<table><tr><td>Standard</td><td>{v}</td></tr><tr><td>Other</td><td>9'00\"</td></tr></table>"
    page = dex_page(8, FIRE, [10], height=small("2'06\""), weight=small("1,000.5lbs"))
    (row,) = result(spark, 8, page)
    assert (row["height_ft"], row["weight_lb"]) == (2.5, 1000.5)


def test_ratio_per_form(spark):
    gender = ("<table><tr><td>Standard</td></tr><tr><td>Male:</td><td>50%</td></tr><tr><td>Female:</td><td>50%</td></tr>"
              "<tr><td>Paldean Form</td></tr><tr><td>Male:</td><td>100%</td></tr><tr><td>Female:</td><td>0%</td></tr></table>")
    alternates = "<td><table><tr><td>Kantonian Form</td><td><b>Paldean</b> Form</td></tr><tr><td>pic</td></tr></table></td>"
    page = dex_page(9, nested(("Normal", FIRE), ("Paldean", ICE)), [10, 20], alternates.replace("<b>Paldean</b> Form", "<b>Paldean Form</b>"), gender=gender)
    rows = result(spark, 9, page)
    assert [(r["dex_no"], r["male_female_rate"]) for r in rows] == [("0001", "1:1"), ("0001p", "Always male")]


def test_special_form_after_alternates(spark):
    tail = ("<table class='dextable'><tr><td class='fooevo' colspan='6'><b>Ultra Burst</b></td></tr></table>"
            "<table class='dextable'><tr><td>Name</td><td>a</td><td>b</td><td>c</td><td>Type</td></tr>"
            f"<tr><td>m</td><td>-</td><td>-</td><td>-</td><td>{ICE}</td></tr>"
            "<tr><td>Classification</td><td>Height</td><td>Weight</td></tr><tr><td>m</td><td>7'06\"</td><td>30.5lbs</td></tr></table>")
    page = dex_page(7, nested(("Necrozma", FIRE), ("Dusk Mane", FIRE + ICE)), [10, 20, 30], "<td><b>Necrozma</b></td><td><b>Dusk Mane</b></td>", tail=tail, key="0800")
    rows = result(spark, 7, page)
    assert [(r["form"], r["type_one"], r["type_two"], r["base_hp"], r["height_ft"]) for r in rows] == [
        ("Necrozma", "Fire", "", 10, 1.0), ("Dusk Mane", "Fire", "Ice", 20, 1.0), ("Ultra Burst", "Ice", "", 30, 7.5)]


def test_broken_dex_page_is_quarantined(spark):
    whole = dex_page(8, FIRE, [10])
    cut = (whole[0], whole[1][: whole[1].index("Effort")])
    good, bad = dex.dex(pages_of(spark, whole, cut), 8)
    assert [r.page_id for r in good.collect()] == [0] and [r.page_id for r in bad.collect()] == [1]
    assert "base_hp: missing" in bad.first().errors


def reasons_of(spark, gen, page):
    good, bad = dex.dex(pages_of(spark, page), gen)
    return good.count(), sorted({e for r in bad.collect() for e in r.errors})


def test_nothing_is_invented(spark):
    two = "<td><b>Plant Form</b></td><td><b>Sandy Form</b></td>"
    lost = dex_page(8, FIRE, [10, 20], two, evs="<b>Plant Form</b><br>1 HP<br><b>Trash Form</b><br>2 HP<br>")
    assert reasons_of(spark, 8, lost) == (1, ["evs: no block for the form"])
    whole = dex_page(8, FIRE, [10])
    assert reasons_of(spark, 8, (whole[0], whole[1].replace("<a>Plant</a>", "-"))) == (0, ["egg_group_one: missing"])
    assert reasons_of(spark, 8, (whole[0], whole[1].replace("5,120", "many"))) == (0, ["base_egg_steps: not a number"])
    assert reasons_of(spark, 8, (whole[0], whole[1].replace("<b>One</b> - <b>Two</b>", ""))) [1] == ["abilities: missing"]


def test_first_rate_serves_all_forms_but_one_name(spark):
    page = dex_page(8, FIRE, [10, 20], "<td><b>Plant Form</b></td><td><b>Sandy Form</b></td>", rate="45<br>(3.9%)")
    assert [r["cptr_rt"] for r in result(spark, 8, page)] == [45, 45]


def test_types_come_from_one_row(spark):
    page = dex_page(8, nested(("Plant Form", FIRE), ("Sandy Form", ICE), ("Trash Form", FIRE)), [10, 20],
                    "<td><b>Plant Form</b></td><td><b>Sandy Form</b></td>")
    assert [(r["type_one"], r["type_two"]) for r in result(spark, 8, page)] == [("Fire", ""), ("Ice", "")]


def test_profile_counts_texts_of_earlier_generations(spark):
    row = dex.profile(pages_of(spark, dex_page(5, FIRE, [10], height="1'00\"<br>2'00\"")), 5).first()
    assert (row.height_ft, row.stats, row.special_forms) == (2, 1, 0) and "One" in row.abilities[0]


def test_pages_are_parsed_once_for_good_and_bad(spark):
    good, bad = moves.moves(pages_of(spark, move_page()), 8)
    for part in (good, bad):
        shape = part._jdf.queryExecution().executedPlan().toString()
        assert "regexp_extract_all" not in shape and "Generate" not in shape


def test_bad_rows_of_left_out_keys_are_quarantined(spark):
    whole, other = dex_page(8, FIRE, [10], key="0503"), dex_page(8, FIRE, [10], key="0504")
    broken = (whole[0], whole[1].replace("5,120", "many"))
    pages = pages_of(spark, whole, broken, other)
    good, bad = dex.dex(pages, 8)
    assert [r.page_id for r in good.collect()] == [2]
    assert [(r.page_id, r.errors) for r in bad.collect()] == [(1, ["base_egg_steps: not a number"])]
    # nothing is lost: good rows, bad rows and the good row of the key that the table leaves out
    assert dex.extract(pages, 8).count() == 3
