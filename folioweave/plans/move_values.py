"""Fixed values of the move tables: where each field stands on a page. Data only.

(first gen, last gen, column, kind, selector, type). Kinds:
  text     n-th direct text of all cells with a class token:      (class, n)
  cell     first text of the k-th cell of a class, page-wide:      (class, k)
  aligned  first text / icon of the k-th centred cell of a row:    (k,)
  icon     icon code in the k-th cell of a class:                  (class, k, path, ending)
  below    text in the row under a label:                          (label, mode, class, k)
  count    icons in a cell: by class and k, or below a label
Types: str, int, float, rate (number or text), pair (number or text that may be missing).
"""

from __future__ import annotations

BW, DP, DEX, DEXDP = "/pokedex-bw/type/", "/pokedex-dp/type/", "/attackdex/type/", "/attackdex-dp/type/"

# Notes that are cut from numbers, by generation and field.
NUMBER_CUTS = {(7, "power_points"): [(" (SMUSUM)", "")], (7, "base_power"): [(" (SMUSUM)", "")]}
# Cuts for the effect rate, by generation.
FIRST_RATE_CUTS = [("--", "—"), (" ", ""), ("%", "")]
LATER_RATE_CUTS = [(" %", ""), ("--", "—")]
RATE_CUTS = {1: FIRST_RATE_CUTS, 2: FIRST_RATE_CUTS, 3: LATER_RATE_CUTS, 4: LATER_RATE_CUTS, 5: LATER_RATE_CUTS,
             6: LATER_RATE_CUTS, 7: LATER_RATE_CUTS, 8: LATER_RATE_CUTS, 9: LATER_RATE_CUTS}
# Fixed value: the label that marks a page with further information.
IN_DEPTH = "In-Depth Effect:"

FIELDS = [
    # generations 1 and 2: by position
    (1, 2, "move_name", "text", ("cen", 0), "str"),
    (1, 2, "move_type", "icon", ("cen", 2, BW, ".gif"), "str"),
    (1, 2, "power_points", "text", ("cen", 3), "int"),
    (1, 2, "base_power", "text", ("cen", 4), "int"),
    (1, 1, "accuracy", "text", ("cen", 5), "float"),
    (2, 2, "accuracy", "text", ("cen", 5), "int"),
    (1, 2, "battle_effect", "text", ("fooinfo", 0), "str"),
    (1, 2, "secondary_effect", "text", ("fooinfo", 1), "str"),
    (1, 2, "effect_rate", "text", ("cen", 6), "rate"),
    (1, 2, "tm_no", "text", ("cen", 7), "str"),
    (1, 2, "speed_priority", "text", ("cen", 8), "int"),
    (1, 2, "hit_range", "text", ("cen", 9), "str"),
    # generation 3
    (3, 3, "move_name", "aligned", (1,), "str"),
    (3, 3, "battle_type", "aligned_icon", (2, DEX, ".gif"), "str"),
    (3, 3, "power_points", "cell", ("cen", 1), "int"),
    (3, 3, "base_power", "cell", ("cen", 2), "int"),
    (3, 3, "accuracy", "cell", ("cen", 3), "int"),
    (3, 3, "battle_effect", "cell", ("fooinfo", 1), "str"),
    (3, 3, "secondary_effect", "cell", ("fooinfo", 2), "str"),
    (3, 3, "effect_rate", "after_br", ("fooevo", 7), "rate"),
    (3, 3, "contest_type", "aligned_icon", (3, DEX, ".gif"), "str"),
    (3, 3, "contest_effect", "cell", ("fooinfo", 3), "str"),
    (3, 3, "appeal", "count", ("cen", 5), "int"),
    (3, 3, "jam", "count", ("cen", 6), "int"),
    (3, 3, "tm_no", "cell", ("cen", 4), "str"),
    (3, 3, "bright_powder", "cell", ("cen", 7), "str"),
    (3, 3, "kings_rock", "cell", ("cen", 8), "str"),
    (3, 3, "physical_contact", "cell", ("cen", 9), "str"),
    (3, 3, "battle_palace_style", "cell", ("cen", 10), "str"),
    (3, 3, "battle_arena", "cell", ("cen", 11), "str"),
    (3, 3, "pokemon_hit", "cell", ("cen", 12), "str"),
    # generations 4 to 9: head of the page
    (4, 9, "move_name", "cell", ("cen", 1), "str"),
    (4, 5, "battle_type", "icon", ("cen", 2, DEX, ".gif"), "str"),
    (6, 9, "battle_type", "icon", ("cen", 2, BW, ".gif"), "str"),
    (4, 5, "category", "icon", ("cen", 3, DP, ".png"), "str"),
    (6, 9, "category", "icon", ("cen", 3, BW, ".png"), "str"),
    (4, 9, "power_points", "cell", ("cen", 4), "int"),
    (4, 9, "base_power", "cell", ("cen", 5), "int"),
    (4, 9, "accuracy", "cell", ("cen", 6), "int"),
    (4, 9, "battle_effect", "cell", ("fooinfo", 1), "str"),
    (4, 9, "further_info", "flag", ("fooleft", 2), "str"),
    (4, 9, "secondary_effect", "below", ("Secondary Effect:", "text", "fooinfo", 1), "str"),
    (4, 9, "effect_rate", "below", ("Effect Rate:", "text", "cen", 1), "rate"),
    # generation 4
    (4, 4, "contest_type", "beside_icon", ("Super Contests", "text", "fooinfo", DEXDP, ".gif"), "str"),
    (4, 4, "contest_effect", "below", ("Effect:", "bold", "fooinfo", 1), "str"),
    (4, 4, "contest_points", "count_below", ("Points:", "bold", "cen", 1), "int"),
    (4, 6, "tm_no", "below", ("TM #", "bold", "cen", 1), "str"),
    (7, 9, "crit_rate", "below", ("Base Critical Hit Rate", "bold", "cen", 1), "str"),
    (4, 9, "speed_priority", "below", ("Speed Priority", "bold", "cen", 2), "str"),
    (4, 9, "pokemon_hit", "below", ("Pokémon Hit in Battle", "bold", "cen", 3), "str"),
    (4, 4, "bright_powder", "below", ("BrightPowder", "bold", "cen", 1), "str"),
    (4, 4, "kings_rock", "below", ("King's Rock", "bold", "cen", 2), "str"),
    (4, 4, "physical_contact", "below", ("Physical Contact", "bold", "cen", 3), "str"),
    # generation 6: contest block, missing on some pages
    (6, 6, "contest_type", "optional_icon", ("Contest Type", "bold", "cen", BW, ".png"), "optional"),
    (6, 6, "contest_effect", "below", ("Contest Effect", "text", "fooinfo", 1), "optional"),
    (6, 6, "appeal", "count_below", ("Appeal", "bold", "cen", 2), "pair"),
    (6, 6, "jam", "count_below", ("Jam", "bold", "cen", 3), "pair"),
    # generations 5 to 9: yes/no rows
    (5, 9, "physical_contact", "below", ("Physical Contact", "contains", "cen", 1), "str"),
    (5, 9, "sound-type", "below", ("Sound-Type", "contains", "cen", 2), "str"),
    (5, 9, "punch move", "below", ("Punch Move", "contains", "cen", 3), "str"),
    (8, 9, "biting move", "below", ("Biting Move", "contains", "cen", 4), "str"),
    (5, 7, "snatchable", "below", ("Sound-Type", "contains", "cen", 4), "str"),
    (8, 9, "snatchable", "below", ("Sound-Type", "contains", "cen", 5), "str"),
    (5, 5, "grounded_by_gravity", "below", ("Grounded by", "contains", "cen", 5), "str"),
    (6, 6, "sky_battles", "below", ("Sky Battles", "contains", "cen", 5), "str"),
    (7, 7, "z_move", "below", ("Z Move", "contains", "cen", 5), "str"),
    (8, 9, "affected_by_gravity", "below", ("Affected by Gravity", "contains", "cen", 1), "str"),
    (5, 7, "defrosts_when_used", "below", ("Defrosts When Used?", "contains", "cen", 1), "str"),
    (8, 9, "defrosts_when_used", "below", ("Defrosts When Used?", "contains", "cen", 2), "str"),
    (5, 7, "opp_side_triple_battles", "below", ("Triple Battles", "contains", "cen", 2), "str"),
    (5, 9, "reflectable", "below", ("Reflected By", "contains", "cen", 3), "str"),
    (5, 9, "blockable", "below", ("Blocked by", "contains", "cen", 4), "str"),
    (5, 9, "copyable", "below", ("Copyable by", "contains", "cen", 5), "str"),
]
