"""Dex tables: one row per page (generations 1 and 2) or per page and form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioweave.functions import lists as L
from folioweave.functions import numbers as N
from folioweave.functions import text as X
from folioweave.functions.literals import sql_value
from folioweave.operators import curate, fields, forms, order, plan, quality, rows
from folioweave.plans import dex_values as V

C = F.col
D = fields.Doc()


def _type_word(path: str, var: str = "x") -> str:
    """SQL text: icon path to a capitalised type name."""
    bare = f"replace(replace({var}, {sql_value(path)}, ''), {sql_value(V.TYPE_END)}, '')"
    return f"initcap({bare})"


def _types(arr: str, path: str) -> str:
    return f"transform({arr}, x -> {_type_word(path)})"


def _int(c: Column) -> Column:
    return N.to_int(X.replace_all(X.clean_ws(c), [(",", "")]))


def _missing(df: DataFrame, names: list[str]) -> dict[str, Column]:
    return {f"{n}: missing": C(n).isNull() for n in names if n in df.columns}


# ---------------------------------------------------------------- generations 1 and 2


def by_position(pages: DataFrame, gen: int) -> DataFrame:
    """Page-grain tables read by position, with ``errors``."""
    path, info = V.TYPE_PATH[gen], D.class_texts("fooinfo")
    icon = "transform(filter(tags, g -> g.tag = 'img' AND g.tbl = b.pos), g -> g.val)"
    dextab = "get(filter(tags, g -> g.tag = 'table' AND array_contains(split(g.cls, ' '), 'dextab')), 0)"
    icons = D.values_in(D.nth(D.cells("cen"), 0))
    raw = {
        "types": F.expr(_types(icons, path)),
        "sprite": F.expr(D.nth(D.let(dextab, icon, "b"), 0)),
    }
    stats = ["hp", "atk", "def", "special", "speed"] if gen == 1 else ["hp", "atk", "def", "sp_atk", "sp_def", "speed"]
    first = -18 if gen == 1 else -21
    for i, s in enumerate(stats):
        raw[s] = F.expr(D.nth(info, first + i))
    if gen == 1:
        places = {"dex_no": 3, "name": 2, "class": 4, "height": 5, "weight": 7, "cptr_rt": 9, "exp_rt": 11}
        raw.update({k: F.expr(D.nth(info, n)) for k, n in places.items()})
    else:
        def cell(k: int) -> str:
            return D.nth(D.cells("fooinfo"), k)
        raw.update({
            "dex_no": F.expr(D.nth(D.class_texts(None), 11)),
            "name": F.expr(D.nth(info, 0)),
            "class": F.expr(D.nth(D.own_texts(cell(5)), 0)),
            "height": F.expr(D.value("Height", 2)),
            "weight": F.expr(D.value("Weight", 3)),
            "cptr_rt": F.expr(D.nth(D.own_texts(cell(8)), 0)),
            "base_egg_steps": F.expr(D.nth(D.own_texts(cell(9)), 0)),
            "exp_rt": F.expr(D.nth(D.texts_after(cell(10), "br"), 0)),
            "ratio": F.expr(D.all_texts(cell(4))),
            "eggs": F.expr(D.let(
                "transform(filter(tags, g -> g.tag = 'table' AND array_contains(split(g.cls, ' '), 'dexitem')), g -> g.pos)",
                "transform(filter(texts, t -> t.prev = 'a' AND array_contains(b, t.tbl)), t -> t.text)", "b")),
        })
    docs = fields.with_labels(fields.documents(pages), ["Height", "Weight"])
    df = plan.pin(docs, {f"raw_{k}": v for k, v in raw.items()}, keep=["page_id"])

    def r(name: str) -> Column:
        return C(f"raw_{name}")

    one, two = L.pair(r("types"))
    feet = L.at(N.feet_inches(X.clean_ws(r("height"))), 0)
    pounds = L.at(N.unit_number(X.clean_ws(r("weight")), "lbs"), 0)
    out = {
        "dex_no": X.zfill(F.replace(X.clean_ws(r("dex_no")), F.lit("#"), F.lit("")), 4),
        "name": X.clean_ws(r("name")),
        "sprite": X.title(F.regexp_replace(r("sprite"), r"^.*/icon/|\.png$", "")),
        "type_one": F.nullif(one, F.lit("")), "type_two": two,
        "class": F.replace(X.clean_ws(r("class")), F.lit(V.CLASS_END), F.lit("")),
        "height_ft": feet, "weight_lb": pounds, "cptr_rt": _int(r("cptr_rt")),
        "exp_rt": X.replace_all(X.clean_ws(r("exp_rt")), [V.SLOW_RATE]),
        **{s: _int(r(s)) for s in stats},
    }
    if gen == 2:
        eg1, eg2 = L.pair(r("eggs"), V.NO_EGGS)
        out.update({
            "male_female_rate": _page_ratio(r("ratio"), gen, both_zero="Always female"),
            "base_egg_steps": _int(r("base_egg_steps")), "egg_group_one": eg1, "egg_group_two": eg2,
        })
    df = df.select("page_id", *[v.alias(k) for k, v in out.items()])
    return quality.validate(df, _missing(df, [c for c in out if c != "type_two"]))


def _page_ratio(texts: Column, gen: int, both_zero: str = "N/A") -> Column:
    """Ratio from the texts of the ratio cell: the two percentages in order."""
    unknown = F.exists(texts, lambda t: t.contains(V.NO_RATIO[gen]))
    shares = F.transform(F.filter(texts, lambda t: t.contains("%")), lambda t: F.regexp_extract(t, r"([0-9.]+)\s*%", 1))
    return N.gender_rate(unknown, L.at(shares, 0), L.at(shares, 1), both_zero)


# ---------------------------------------------------------------- generation 3


def by_stat_block(pages: DataFrame) -> DataFrame:
    """Generation 3: one row per captioned stat block, with ``errors``."""
    gen, path = 3, V.TYPE_PATH[3]
    head = "filter(cells, c -> c.cls = 'fooinfo' AND c.colspan = '7')"
    block = ("named_struct('form', coalesce(get(transform(filter(texts, t -> t.cell = c.pos AND t.prev = '/b'), t -> t.text), 0), ''), "
             "'stats', transform(filter(texts, t -> t.tbl = c.tbl AND t.cls = 'cen' AND t.direct), t -> t.text))")
    egg_table = "get(filter(named, t -> contains(t.text, 'Egg Groups') AND t.cls = 'fooevo'), 0)"
    info = D.class_texts("fooinfo")
    raw = {
        "dex_no": F.expr(D.nth(info, 3)), "name": F.expr(D.nth(info, 5)),
        "class": F.expr(D.value("Height", 1)),
        "dex_cat": F.expr(D.let(D.value_cell("Dex Category", 2),
                                "get(transform(filter(tags, g -> g.tag = 'img' AND g.cell = b.pos), g -> g.title), 0)", "b")),
        "color": F.expr(D.value("Dex Category", 3)),
        "height": F.expr(D.value("Height", 4)), "weight": F.expr(D.value("Height", 5)),
        "male": F.expr(D.value("Gender Ratio", 1, "bold")), "female": F.expr(D.value("Gender Ratio", 2, "bold")),
        "steps": F.expr(D.value("Egg Steps to Hatch", 1)), "evs": F.expr(D.value("Egg Steps to Hatch", 2)),
        "cptr_rt": F.expr(D.value("Egg Steps to Hatch", 3)),
        "types": F.expr(f"transform(filter(tags, g -> g.tag = 'img' AND startswith(g.val, {sql_value(path)})), g -> {_type_word(path, 'g.val')})"),
        "abilities": F.expr(D.let(
            "transform(filter(cells, c -> c.colspan = '4'), c -> c.pos)",
            "get(transform(filter(texts, t -> t.prev = 'b' AND array_contains(b, t.cell)), t -> t.text), 0)", "b")),
        "eggs": F.expr(D.let(egg_table, "slice(transform(filter(texts, t -> t.tbl = b.tbl AND t.direct), t -> t.text), 4, 2)", "b")),
        "blocks": F.expr(f"transform({head}, c -> {block})"),
    }
    labels = ["Height", "Dex Category", "Gender Ratio", "Egg Steps to Hatch", "Egg Groups"]
    docs = fields.with_labels(fields.documents(pages), labels)
    df = plan.pin(docs, {f"raw_{k}": v for k, v in raw.items()}, keep=["page_id"])
    df = df.select("*", F.posexplode("raw_blocks").alias("form_index", "block"))

    def r(name: str) -> Column:
        return X.clean_ws(C(f"raw_{name}"))

    form = C("block")["form"]
    vec = L.stat_vector(
        F.transform(F.split(r("evs"), ", "), lambda x: F.replace(x, F.lit(":"), F.lit(""))), number_first=False,
        slots=["HP", "Attack", "Defense", "Special Attack", "Special Defense", "Speed"])
    share = r"([0-9.]+)"
    ratio = N.gender_rate(r("male").contains(V.NO_RATIO[3]), F.regexp_extract(r("male"), share, 1), F.regexp_extract(r("female"), share, 1))
    one, two = L.pair(C("raw_types"))
    ab1, ab2 = L.split2(F.replace(r("abilities"), F.lit("Ability: "), F.lit("")), " & ")
    eg1, eg2 = L.pair(C("raw_eggs"))
    key = X.zfill(r("dex_no"), 4)
    df = df.select(
        "page_id", "form_index",
        F.when(form == "", key).otherwise(F.concat(key, F.lower(X.py_slice(form, 2, 4)))).alias("dex_no"),
        X.zfill(r("name"), 4).alias("name"),
        X.replace_all(form, [(" (", ""), (")", ""), ("Defence", "Defense"), ("Form", "form")]).alias("form"),
        F.replace(r("class"), F.lit(V.CLASS_END), F.lit("")).alias("class"),
        X.capitalize(r("dex_cat")).alias("dex_cat"), X.capitalize(r("color")).alias("color"),
        L.at(N.feet_inches(r("height")), 0).alias("height_ft"), L.at(N.unit_number(r("weight"), " lbs"), 0).alias("weight_lb"),
        ratio.alias("male_female_rate"), one.alias("type_one"),
        F.when(F.lower(two) == V.NO_TYPE, "").otherwise(two).alias("type_two"),
        ab1.alias("ability_one"), ab2.alias("ability_two"),
        *[_int(L.at(C("block")["stats"], i)).alias(c) for i, c in enumerate(V.BASE_STATS)],
        _int(C("raw_cptr_rt")).alias("cptr_rt"),
        N.to_int(X.replace_all(r("steps"), [(",", ""), (" Steps", "")])).alias("base_egg_steps"),
        X.recode(X.clean_ws(eg1), {"Cannot Breed": V.NO_EGGS}).alias("egg_group_one"), X.clean_ws(eg2).alias("egg_group_two"),
        vec.alias("evs"),
    )
    df = df.select("*", *[L.at(C("evs"), i).alias(c) for i, c in enumerate(V.EVS)]).drop("evs")
    must = ["dex_no", "name", "class", "height_ft", "weight_lb", "type_one", *V.BASE_STATS, "cptr_rt", "base_egg_steps"]
    return quality.validate(df, _missing(df, must))


# ---------------------------------------------------------------- generations 4 to 9


def page_fields(pages: DataFrame, gen: int, more: dict[str, str] | None = None) -> DataFrame:
    """Page-level raw values of a multi-form page, each looked up once; ``more`` adds selectors."""
    path = V.TYPE_PATH[gen]
    head = "h2" if gen >= 7 else "b"
    type_cell = D.value_cell("Type", 5)
    in_row = "x.pos > r.pos AND (r.stop IS NULL OR x.pos < r.stop)"
    type_rows = D.let(
        type_cell,
        "transform(filter(tags, g -> g.tag = 'tr' AND g.pos > b.pos AND (b.stop IS NULL OR g.pos < b.stop)), r -> named_struct("
        f"'form', get(transform(filter(texts, x -> {in_row} AND trim(x.text) <> ''), x -> x.text), 0), "
        f"'types', transform(filter(tags, x -> x.tag = 'img' AND {in_row} AND startswith(x.val, {sql_value(path)})), x -> {_type_word(path, 'x.val')})))",
        "b")
    stat_tables = (
        "transform(filter(named, t -> contains(t.text, 'Base Stats') AND t.direct AND t.cls = 'fooinfo'), t -> transform("
        "slice(filter(cells, c -> c.tbl = t.tbl AND c.row_no = t.row_no AND c.col_no > t.col_no), 1, 6), "
        "c -> try_cast(trim(get(transform(filter(texts, x -> x.cell = c.pos AND x.direct), x -> x.text), 0)) AS INT)))")
    special = D.let(
        "transform(filter(cells, c -> c.colspan = '6'), c -> c.pos)",
        f"filter(texts, t -> t.cls = 'fooevo' AND t.prev = '{'b' if gen <= 7 else 'h2'}' AND array_contains(wide, t.cell))", "wide")
    # what stands between a special form's heading and the next one
    span = "t.pos > s.pos AND (n.pos IS NULL OR t.pos < n.pos)"
    def after(label: str, cell: int) -> str:
        return D.value_cell(label, cell, where=span)
    special_block = D.let(
        "get(sp, i + 1)",
        "named_struct('form', trim(s.text), "
        f"'types', {_types(D.values_in(after('Type', 5), starts=path), path)}, "
        f"'height', {D.nth(D.all_texts(after('Height', 2)), 0)}, "
        f"'weight', {D.nth(D.all_texts(after('Weight', 3)), 0)})", "n")
    specials = D.let(special, f"transform(sp, (s, i) -> {special_block})", "sp")

    egg_cells = "t.cls = 'fooinfo'" if gen >= 6 else f"t.cell = {D.value_cell('Egg Groups', 2, cls='fooinfo')}.pos"
    egg_row = D.row_below("Egg Groups")
    nested_first_row = D.let(
        D.row_below("Alternate Forms"),
        "transform(filter(cells, c -> c.pos > b.pos AND (b.stop IS NULL OR c.pos < b.stop) AND c.depth > b.depth AND c.row_no = 1), "
        "c -> array_join(transform(filter(texts, x -> x.pos > c.pos AND (c.stop IS NULL OR x.pos < c.stop)), x -> trim(x.text)), ''))", "b")
    standard = {  # a cell that nests a small table of variants
        k: D.nth(D.own_texts(D.beside_cell("Standard", "text", where=f"t.pos > {D.value_cell(lbl, n)}.pos AND t.pos < {D.value_cell(lbl, n)}.stop")), 0)
        for k, lbl, n in (("height", "Height", 2), ("weight", "Weight", 3))
    }
    ev_cell = D.value_cell("Effort Values Earned", 3)
    ev_text = D.let(
        ev_cell,
        "CASE WHEN b.pos IS NULL THEN NULL ELSE array_join(transform(filter(texts, t -> t.cell = b.pos AND trim(t.text) <> ''), "
        "t -> CASE WHEN t.prev = 'b' THEN concat('<b>', trim(t.text), '</b>') ELSE trim(t.text) END), '<br>') END", "b")
    ability_text = D.let(
        "transform(filter(named, t -> t.text = 'Abilities' AND t.prev = 'b'), t -> t.cell)",
        "array_join(transform(filter(texts, x -> array_contains(b, x.cell)), x -> x.text), '')", "b")
    raw = {
        "dex_no": D.nth(D.own_texts(D.beside_cell("National", "bold")), 0),
        "name": D.value("Type", 1),
        "class": D.value("Classification", 1),
        "height": D.value("Height", 2), "weight": D.value("Weight", 3),
        "gender": D.all_texts(D.value_cell("Gender Ratio", 4)),
        "evs": ev_text,
        "exp_growth": D.nth(D.texts_after(D.value_cell("Experience Growth", 1), "br"), 0),
        "egg_steps": D.value("Base Egg Steps", 5),
        "cptr_rt": D.own_texts(D.value_cell("Capture Rate", 4) if gen >= 7 else D.value_cell("Base Egg Steps", 4)),
        "eggs": D.texts_with(egg_row, f"t.prev = 'a' AND {egg_cells}"),
        "no_eggs": f"size({D.texts_with(egg_row, 'endswith(trim(t.text), ' + sql_value(V.CANNOT_BREED) + ')')}) > 0",
        "type_rows": type_rows,
        "types": _types(D.values_in(type_cell, starts=path), path),
        "stat_tables": stat_tables,
        "n_captions": f"size(filter(named, t -> contains(t.text, 'Stats') AND t.prev = '{head}'))",
        "alternates": nested_first_row if gen == 9 else D.texts_with(D.row_below("Alternate Forms"), "t.prev = 'b'"),
    }
    if gen == 4:
        raw["color"] = D.value("Colour", 4)
        raw["abilities"] = D.texts_with(D.value_cell("Ability", 1, "bold"), "t.prev = 'b'")
    else:
        raw["abilities"] = ability_text
    if gen >= 6:
        raw["specials"] = specials
        raw["extra"] = D.nth(D.all_texts(D.value_cell(V.EXTRA[gen][1], 4)), 0)
    if gen >= 8:
        raw["std_height"], raw["std_weight"] = standard["height"], standard["weight"]
    raw.update(more or {})
    labels = ["National", "Type", "Classification", "Height", "Weight", "Gender Ratio", "Effort Values Earned",
              "Experience Growth", "Base Egg Steps", "Capture Rate", "Egg Groups", "Stats", "Alternate Forms", "Colour",
              "Ability", "Abilities", "Standard"] + ([V.EXTRA[gen][1]] if gen in V.EXTRA else [])
    docs = fields.with_labels(fields.documents(pages), labels)
    return plan.pin(docs, {k: F.expr(v) for k, v in raw.items()}, keep=["page_id"])


def _recode_type_rows(gen: int) -> Column:
    """Form names beside the types, written as the form list writes them."""
    def one(row: Column) -> Column:
        seen = row["form"]
        out = None
        if gen == 8:
            fire = row["types"] == F.array(*[F.lit(t) for t in V.MODE_TYPES])
            special, other, plain = V.MODE_FORMS
            mode = (F.when(seen == "Normal", "Normal Standard Mode").when((seen == V.MODE) & fire, special)
                    .when(seen == V.MODE, other).otherwise(plain))
            out = F.when(C("name") == V.MODE_NAME, mode)
        for name, old, new in V.of_gen(V.TYPE_FORMS, gen):
            hit = (seen == old) if name is None else (seen == old) & (C("name") == name)
            out = F.when(hit, F.lit(new)) if out is None else out.when(hit, F.lit(new))
        return F.struct((out.otherwise(seen) if out is not None else seen).alias("form"), row["types"].alias("types"))

    return F.transform("type_rows", one)


def dex_forms(pages: DataFrame, gen: int) -> DataFrame:
    """Generations 4 to 9: one row per page and form, with ``errors``.

    One exchange (pages by id). Pages turn into form rows by a generator; types, stats and
    effort values of a form are looked up in arrays and maps of its own row.
    """
    df = page_fields(pages, gen).withColumn("name", X.clean_ws(C("name")))
    none = F.expr("cast(array() as array<string>)")
    special = F.transform("specials", lambda s: s["form"]) if gen >= 6 else none
    alternates = F.transform("alternates", lambda a: X.strip(a))
    if gen in V.FORM_CUTS:
        alternates = F.transform(alternates, lambda a: X.replace_all(a, V.FORM_CUTS[gen]))
    variants = C("n_captions") > 1
    if gen >= 7:
        variants = variants | ((F.size("type_rows") > 1) & (C("name") != V.ONE_FORM_NAME))
    form_list = rows.derive_forms(special, alternates, variants, V.FIXED_FORMS.get(gen), C("name"))
    if gen == 7:
        burst = F.size(special) == 1
        form_list = F.when(burst & (L.at(special, 0) == "Ultra Burst"), F.concat(alternates, special)).otherwise(form_list)

    # effort values by heading; a page with one block uses it for all forms
    heads, first = V.FIRST_HEADING.get(gen, ([], ""))
    regional = F.lit(False)
    for h in heads:
        regional = regional | C("evs").contains(h)
    if gen >= 8:
        regional = regional & ~C("evs").contains(V.MODE)
    pinned = plan.pin(df, {
        "forms": form_list,
        "n_special": F.size(special),
        "named_types": _recode_type_rows(gen),
        "ev_map": F.when(regional, L.segments_to_map(C("evs"), first)).otherwise(L.segments_to_map(C("evs"), "")),
    }, keep=[c for c in df.columns if c != "type_rows"])
    form_rows = rows.explode_forms(pinned.withColumn("n_forms", F.size("forms")), "forms")
    return _finish_forms(_resolve(form_rows, gen), gen)


def _resolve(df: DataFrame, gen: int) -> DataFrame:
    """Types, stats and effort values of each form row, pinned."""
    i, form, name = C("form_index"), C("form"), C("name")
    n_types, n_stats = F.size("named_types"), F.size("stat_tables")
    mode, stat = forms.resolve_forms(n_types, C("n_forms"), n_stats, i, C("n_special") if gen >= 6 else None, gen)
    equal = (n_types == C("n_forms")) & (C("n_forms") == n_stats)
    plain = C("n_special") == 0
    for gens, who, type_mode, tables, after_equal in reversed(V.STAT_TABLES):
        if gen in gens:
            hit = plain & (name == who) & (~equal if after_equal else F.lit(True))
            table_no = F.try_element_at(F.array(*[F.lit(t) for t in tables]), F.least(i + 1, F.lit(len(tables))))
            mode, stat = F.when(hit, F.lit(type_mode)).otherwise(mode), F.when(hit, table_no).otherwise(stat)

    by_name = L.at(F.filter("named_types", lambda r: r["form"] == form), 0)["types"]
    by_index = F.get("named_types", i)["types"]
    if gen >= 6:
        block = F.get("specials", i - (C("n_forms") - C("n_special")))
        shared = F.when(F.size("named_types") > 0, F.coalesce(by_index, L.at(C("named_types"), 0)["types"])).otherwise(C("types"))
        special_types = F.when(i < C("n_forms") - C("n_special"), shared).otherwise(block["types"])
    # icons of different type rows are never taken together
    whole_page = F.when(n_types == 0, C("types")).otherwise(by_name)
    picked = F.when(mode == "map", by_name).when(mode == "index", by_index).otherwise(whole_page)
    if gen >= 6:
        picked = F.when(C("n_special") > 0, special_types).otherwise(picked)

    heading = form
    for who, which, value in reversed(V.of_gen(V.EFFORT_FORMS, gen)):
        hit = (name == who) & (form == which if which else F.lit(True))
        heading = F.when(hit, F.lit(value)).otherwise(heading)
    evs = F.when(F.size("ev_map") == 1, L.at(F.map_values("ev_map"), 0)).otherwise(L.lookup(C("ev_map"), heading))

    out = {"type_list": picked, "stats": F.get("stat_tables", stat), "ev_items": evs, "n_evs": F.size("ev_map")}
    if gen >= 6:
        out["special"] = F.when(C("n_special") > 0, block)
    used = {"named_types", "stat_tables", "ev_map", "types"} | ({"specials"} if gen >= 6 else set())
    return plan.pin(df, out, keep=[c for c in df.columns if c not in used])


def _ability_groups() -> Column:
    """Ability lists of a page: groups of names."""
    groups = L.split_literal(X.strip(C("abilities")), " Abilities: ")
    clean = F.transform(groups, lambda g: X.replace_all(g, [("Abilities: ", ""), ("- B2W2", "B2W2")]))
    return F.transform(clean, lambda g: L.split_literal(g, " - "))


def _ratio_by_form(gen: int) -> Column:
    """Ratio of a form row; generation 9 may state one ratio per form."""
    whole = _page_ratio(C("gender"), gen)
    if gen < 9:
        return whole
    heads = F.transform(F.filter("gender", lambda t: ~t.rlike(r"[%:]") & (X.strip(t) != "")),
                        lambda t: X.recode(X.strip(t), {"Standard": "Normal"}))
    shares = F.transform(F.filter("gender", lambda t: t.contains("%")), lambda t: F.regexp_extract(t, r"([0-9.]+)\s*%", 1))
    at = F.array_position(heads, C("form")).cast("int")
    split = N.gender_rate(F.lit(False), F.get(shares, 2 * at - 2), F.get(shares, 2 * at - 1))
    return F.when(F.size(shares) >= 4, F.when(at > 0, split)).otherwise(whole)


def _finish_forms(df: DataFrame, gen: int) -> DataFrame:
    """Typed columns, key suffixes, rules and checks."""
    i, form = C("form_index"), C("form")
    height, weight = C("height"), C("weight")
    if gen >= 8:
        blank = F.coalesce(X.strip(height), F.lit("")) == ""
        height = F.when(blank, C("std_height")).otherwise(height)
        weight = F.when(blank, C("std_weight")).otherwise(weight)
    if gen >= 6:
        height = F.coalesce(C("special")["height"], height)
        weight = F.coalesce(C("special")["weight"], weight)
    steps = X.replace_all(X.strip(C("egg_steps")), [(",", ""), (" (SWSH)", ""), (" Steps", "")])
    eg1, eg2 = L.pair(C("eggs"))
    first_rate = L.at(C("cptr_rt"), 0)
    own_rate = F.when(C("name") == V.RATE_BY_FORM_NAME, F.get("cptr_rt", i)).otherwise(first_rate) if gen >= 7 else first_rate
    rate = X.strip_parens(X.clean_ws(own_rate))
    listed = F.size("ev_items") > 0
    vec = F.when(listed, L.stat_vector(C("ev_items")))
    one, second = L.pair(C("type_list"))
    two = F.when(F.size("type_list") == 2, second).otherwise(F.lit(""))
    out = {
        "page_id": C("page_id"),
        "dex_no": X.zfill(F.replace(X.clean_ws(C("dex_no")), F.lit("#"), F.lit("")), 4),
        "form_index": i, "name": C("name"), "form": form,
        "class": F.replace(X.clean_ws(C("class")), F.lit(V.CLASS_END), F.lit("")),
    }
    if gen == 4:
        out["color"] = X.clean_ws(C("color"))
    out.update({
        "height_ft": L.at(N.feet_inches(X.clean_ws(height)), 0),
        "weight_lb": L.at(N.unit_number(X.clean_ws(weight), "lbs"), 0),
        "male_female_rate": _ratio_by_form(gen),
        "type_one": F.nullif(one, F.lit("")), "type_two": two,
    })
    if gen == 4:
        ab1, ab2 = L.pair(C("abilities"))
        out.update({"ability_one": ab1, "ability_two": ab2})
    else:
        groups, which = _ability_groups(), F.lit(0)
        if gen >= 6:
            # a page of special forms: the base form's abilities three times, then the special form's
            spread = L.repeat_items(groups, F.array(F.lit(3), F.lit(1)))
            several_base = C("n_forms") - C("n_special") > 1
            which = F.when(C("n_special") > 0, i).otherwise(F.lit(0))
            if gen >= 8:
                groups = spread
            elif gen == 7:
                groups = F.when((C("n_special") > 0) & several_base, spread).otherwise(groups)
        out["abilities"] = F.coalesce(F.get(groups, which), F.get(groups, F.lit(0)))
    out.update({c: L.at(C("stats"), k) for k, c in enumerate(V.BASE_STATS)})
    out.update({
        "cptr_rt": N.to_int(rate),
        "exp_growth": X.clean_ws(C("exp_growth")),
        "base_egg_steps": N.to_int(steps),
        "base_egg_steps_raw": F.when(steps == "", F.lit("N/A")).otherwise(steps),
        "egg_group_one": F.when(C("no_eggs"), F.lit(V.NO_EGGS)).otherwise(F.nullif(eg1, F.lit(""))),
        "egg_group_two": F.when(C("no_eggs"), F.lit("")).otherwise(eg2),
    })
    if gen in V.EXTRA:
        col, _, recodes = V.EXTRA[gen]
        text = X.strip(C("extra"))
        out[col] = X.recode(X.py_slice(text, -11), recodes) if recodes else text
    out["ev_vector"] = vec
    out["evs_raw"] = F.when(listed, F.array_join("ev_items", ", ")).otherwise(F.lit(V.NOT_LISTED))
    out["_evs"] = C("evs").isNull() | (C("n_evs") > 1) & ~F.coalesce(listed, F.lit(False))
    # a blank cell stands for no steps from generation 6 on; other texts must be numbers
    blank_steps = (steps == "") & F.lit(gen >= 6)
    out["_steps"] = ~F.coalesce(blank_steps, F.lit(False)) & N.to_int(steps).isNull()
    df = df.select(*[v.alias(k) for k, v in out.items()])
    df = df.select("*", *[L.at(C("ev_vector"), k).alias(c) for k, c in enumerate(V.EVS)]).drop("ev_vector")

    must = ["dex_no", "name", "class", "height_ft", "weight_lb", "male_female_rate", "type_one", *V.BASE_STATS, "cptr_rt",
            "exp_growth", "egg_group_one", *([V.EXTRA[gen][0]] if gen in V.EXTRA else [])]
    no_ability = (F.coalesce(C("ability_one"), F.lit("")) == "" if gen == 4
                  else ~F.coalesce(F.exists("abilities", lambda a: F.trim(F.replace(a, F.lit("Abilities:"), F.lit(""))) != ""), F.lit(False)))
    df = quality.validate(df, {**_missing(df, must), "abilities: missing": no_ability, "evs: no block for the form": C("_evs"),
                               "base_egg_steps: not a number": C("_steps")}).drop("_evs", "_steps")
    return _key_rules(df.withColumn("base_key", C("dex_no")), gen)


def _key_rules(df: DataFrame, gen: int) -> DataFrame:
    """Form suffix on the key, then the ordered overrides."""
    df = df.withColumn("dex_no", X.form_suffix(C("dex_no"), C("form")))
    base = C("base_key")
    todo = [curate.rule({"dex_no": V.PLAIN_KEYS[gen]}, {"dex_no": base}, ["base_key"])] if gen in V.PLAIN_KEYS else []
    if gen >= 8:
        todo += [curate.rule({"form": a}, {"form": b}) for a, b in V.FORM_LABELS.items()]
    todo += [curate.rule({"form": f}, {"dex_no": F.concat(base, F.lit(s)) if s else base}, ["base_key"])
             for f, s in V.of_gen(V.FORM_SUFFIXES, gen)]
    if gen >= 8:
        todo += [curate.rule({"form": f}, {"male_female_rate": r}) for f, r in V.FORM_RATIOS.items()]
    return curate.apply_rules(df, todo)


# ---------------------------------------------------------------- tables


def extract(pages: DataFrame, gen: int) -> DataFrame:
    if gen <= 2:
        return by_position(pages, gen)
    return by_stat_block(pages) if gen == 3 else dex_forms(pages, gen)


def dex(pages: DataFrame, gen: int, ordered: bool = True) -> tuple[DataFrame, DataFrame]:
    """(dex table, quarantined rows with reasons).

    Rows are split before any is dropped: keys that the table leaves out still show up among the bad rows.
    """
    good, bad = quality.write_split(extract(pages, gen), f"dex-g{gen}")
    if gen in V.DROPPED_KEYS:
        good = curate.exclude(good, "dex_no", V.DROPPED_KEYS[gen])
    if ordered:
        if gen >= 4:
            good = order.sort_by_base_key(good, "base_key", "form_index", ["page_id"])
        else:
            good = order.sort_by(good, ["dex_no"], ["page_id"])
    extra = [c for c in ("base_key", "form_index") if c in good.columns]
    return good.drop(*extra).withColumn("gen", F.lit(gen)), bad.select("page_id", "errors")


def profile(pages: DataFrame, gen: int = 8) -> DataFrame:
    """How many nodes each selector finds per page, and which form rule the page would use. Generations 4 to 9."""
    if gen < 4:
        raise ValueError("pages of the first three generations are read by position and have no forms to profile")
    more = {"height_texts": f"size({D.all_texts(D.value_cell('Height', 2))})"}
    df = page_fields(pages, gen, more)
    n_types, n_forms, n_stats = F.size("type_rows"), F.size("alternates"), F.size("stat_tables")
    special = F.size("specials") if gen >= 6 else F.lit(0)
    rule = (F.when(special > 0, "special forms").when((n_types == n_forms) & (n_forms == n_stats), "types = forms = stats")
            .when((n_types == n_forms) & (n_stats == 1), "types = forms, one stat table")
            .when((n_types == 0) & (n_forms == n_stats), "no types, forms = stats")
            .when((n_types == 0), "no types, forms differ from stats")
            .when((n_types != n_forms) & (n_forms == n_stats), "types differ, forms = stats").otherwise("else"))
    steps = X.replace_all(X.strip(C("egg_steps")), [(",", ""), (" (SWSH)", "")])
    abilities = F.array(C("abilities")) if gen > 4 else C("abilities")
    out = {
        "dex_no": X.zfill(F.replace(X.clean_ws(C("dex_no")), F.lit("#"), F.lit("")), 4), "name": X.clean_ws(C("name")),
        "selector": rule, "special_forms": special, "forms": n_forms, "types": n_types, "stats": n_stats,
        "stat_captions": C("n_captions"), "class": F.replace(X.clean_ws(C("class")), F.lit(V.CLASS_END), F.lit("")),
        "height_ft": C("height_texts"), "male_female_rate": _page_ratio(C("gender"), gen), "abilities": abilities,
        "ability_groups": F.size(_ability_groups()) if gen > 4 else F.lit(1), "cptr_rt": F.length(L.at(C("cptr_rt"), 0)),
        "exp_growth": X.clean_ws(C("exp_growth")), "base_egg_steps": N.to_int(steps), "egg_groups": C("eggs"),
    }
    if gen in V.EXTRA:
        col, _, recodes = V.EXTRA[gen]
        text = X.strip(C("extra"))
        out[col] = X.recode(X.py_slice(text, -11), recodes) if recodes else text
    out["evs"] = F.map_keys(L.segments_to_map(C("evs")))
    return df.select("page_id", *[v.alias(k) for k, v in out.items()])
