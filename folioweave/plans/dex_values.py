"""Fixed values of the dex tables: labels, paths, name lists, key rules. Data only."""

from __future__ import annotations

# Start of the type icons' paths per generation, and their ending.
TYPE_PATH = {1: "/pokedex-bw/type/", 2: "/pokedex-bw/type/", 3: "/pokedex-rs/type/", 4: "/pokedex-dp/type/",
             5: "/pokedex-dp/type/", 6: "/pokedex-bw/type/", 7: "/pokedex-bw/type/", 8: "/pokedex-bw/type/",
             9: "/pokedex-bw/type/"}
TYPE_END = ".gif"
NO_TYPE = "na"  # icon name of an empty second type, generation 3

# Wording of pages.
CLASS_END = " Pokémon"
NO_RATIO = {2: "Genderless", 3: "Genderless", 4: "Genderless", 5: "Genderless", 6: "Genderless", 7: "Genderless",
            8: "Gender Unknown", 9: "Gender Unknown"}
CANNOT_BREED = "cannot breed"
NO_EGGS = "No Eggs Discovered"
NOT_LISTED = "Not listed"
SLOW_RATE = ("1,250,000 Points", "Slow")

# The column that only one generation has: name, label, recodes.
EXTRA = {
    6: ("sky_battle", "Eligible for Sky Battle?", {}),
    7: ("sos_calling", "S.O.S. Calling", {}),
    8: ("dynamax", "Dynamax Capable?", {"can Dynamax": "Yes", "not Dynamax": "No"}),
    9: ("change_tera", "Can Change Tera Type?", {}),
}

# Alternate form names that count as the normal form, and joined words, from generation 8.
FORM_CUTS = {
    8: [("Kantonian Form", "Normal"), ("Johtonian Form", "Normal"), ("Hoennian Form", "Normal"), ("Unovan Form", "Normal"),
        ("Kalosian Form", "Normal"), ("Alolan Form", "Normal")],
    9: [("Kantonian Form", "Normal"), ("Johtonian Form", "Normal"), ("Hoennian Form", "Normal"), ("Unovan Form", "Normal"),
        ("Kalosian Form", "Normal"), ("Alolan Form", "Normal"), ("Paldean FormA", "Paldean Form A"),
        ("Paldean FormB", "Paldean Form B"), ("Paldean FormC", "Paldean Form C")],
}

# Forms of names whose page lists them otherwise.
FIXED_FORMS = {
    7: {"Minior": ["Meteor Form", "Core Form"], "Floette": ["", "Eternal Flower"]},
    8: {"Minior": ["Meteor Form", "Core Form"],
        "Darmanitan": ["Normal Standard Mode", "Normal Zen Mode", "Galarian Form Standard Mode", "Galarian Form Zen Mode"],
        "Indeedee": ["Male", "Female"], "Basculegion": ["Male", "Female"],
        "Pikachu": [""], "Burmy": [""], "Cherrim": [""], "Shellos": [""], "Gastrodon": [""], "Arceus": [""]},
    9: {"Minior": ["Meteor Form", "Core Form"], "Ursaluna": ["Normal", "Bloodmoon"],
        "Meowstic": ["Male", "Female"], "Indeedee": ["Male", "Female"], "Basculegion": ["Male", "Female"],
        "Pikachu": [""], "Burmy": [""], "Cherrim": [""], "Shellos": [""], "Gastrodon": [""], "Arceus": [""]},
}
# Fixed value: the name whose forms have a capture rate each; all others take the first.
RATE_BY_FORM_NAME = "Minior"
# Fixed value: a name whose several type rows do not make forms.
ONE_FORM_NAME = "Castform"

# Fixed values: (first gen, last gen, name or None for all, form name beside the types, form name).
TYPE_FORMS = [
    (5, 7, "Darmanitan", "Normal", "Standard Mode"),
    (8, 8, "Darmanitan", "Normal", "Normal Standard Mode"),
    (9, 9, "Tauros", "Paldean", "Paldean Form Combat Breed"),
    (9, 9, "Tauros", "Blaze Breed", "Paldean Form Blaze Breed"),
    (9, 9, "Tauros", "Aqua Breed", "Paldean Form Aqua Breed"),
    (8, 9, "Necrozma", "Normal", "Necrozma"),
    (9, 9, "Ursaluna", "Bloodmoon Form", "Bloodmoon"),
    (7, 7, None, "Normal", "Normal Form"),
    (7, 9, None, "Alolan", "Alola Form"),
    (8, 9, None, "Galarian", "Galarian Form"),
    (8, 9, None, "Hisuian", "Hisuian Form"),
    (9, 9, None, "Paldean", "Paldean Form"),
]
# The split of one name's second mode by its types, generation 8.
MODE_NAME, MODE, MODE_TYPES = "Darmanitan", "Zen Mode", ["Fire", "Psychic"]
MODE_FORMS = ("Normal Zen Mode", "Galarian Form Zen Mode", "Galarian Form Standard Mode")

# Regional headings that imply an unnamed first block, with that block's name.
FIRST_HEADING = {
    7: (["Alola Form"], "Normal Form"),
    8: (["Alola Form", "Galarian Form", "Hisuian Form"], "Normal"),
    9: (["Alola Form", "Galarian Form", "Hisuian Form", "Paldean Form"], "Normal"),
}

# Fixed values: (first gen, last gen, name, form or None for all other forms, heading of its effort values).
EFFORT_FORMS = [
    (5, 7, "Darmanitan", "Standard Mode", "Standard"),
    (5, 5, "Watchog", None, "Black 2 & White 2"),
    (8, 8, "Darmanitan", "Normal Standard Mode", "Standard"),
    (8, 8, "Darmanitan", "Galarian Form Standard Mode", "Galarian Form"),
    (8, 8, "Darmanitan", None, "Zen Mode"),
    (9, 9, "Tauros", "Normal", "Normal"),
    (9, 9, "Tauros", None, "Paldean Form"),
]

# Stat tables (0-based) of names that break the counting rules, by form index; the last repeats.
# (gens, name, type mode, tables, only after the all-equal rule failed)
STAT_TABLES = [
    ((8,), "Rotom", "map", [0, 1], False),
    ((8,), "Zygarde", "shared", [1, 0, 2], True),
    ((8,), "Palkia", "shared", [0, 4], True),
    ((8,), "Dialga", "shared", [0, 4], True),
    ((8,), "Basculegion", "shared", [0, 2], True),
    ((8,), "Enamorus", "shared", [0, 2], True),
    ((8, 9), "Wormadam", "map", [0, 1, 2, 3, 4, 5], True),
]

# Keys that lose their suffix.
PLAIN_KEYS = {
    5: ["0386no", "0479ro", "0555st", "0646ky"],
    6: ["0386no", "0479ro", "0555st", "0646ky"],
    7: ["0386no", "0479ro", "0555st", "0646ky"],
    8: ["0386no", "0479ro", "0555st", "0646ky", "0800ne", "0898ca"],
    9: ["0386no", "0479ro", "0483di", "0484pa", "0555st", "0646ky", "0800ne", "0898ca"],
}

# Fixed values: (first gen, last gen, form, key suffix).
FORM_SUFFIXES = [
    (7, 7, "Normal Form", ""),
    (8, 9, "Normal", ""),
    (6, 9, "Mega Evolution", "meg"),
    (6, 9, "Mega Evolution X", "meg-x"),
    (6, 9, "Mega Evolution Y", "meg-y"),
    (8, 8, "Normal Standard Mode", ""),
    (8, 8, "Normal Zen Mode", "ze"),
    (8, 8, "Galarian Form Standard Mode", "g"),
    (8, 8, "Galarian Form Zen Mode", "g-ze"),
    (9, 9, "Paldean Form Combat Breed", "pc"),
    (9, 9, "Paldean Form Blaze Breed", "pb"),
    (9, 9, "Paldean Form Aqua Breed", "pa"),
    (7, 9, "Midday Form", "md"),
    (7, 9, "Midnight Form", "mn"),
    (6, 9, "Hoopa Confined", "co"),
    (6, 9, "Hoopa Unbound", "un"),
    (8, 9, "10% Forme", "te"),
    (8, 9, "50% Forme", "fi"),
    (8, 9, "Alolan Form", "a"),
    (8, 9, "Galarian Form", "g"),
    (8, 9, "Hisuian Form", "h"),
    (9, 9, "Paldean Form", "p"),
]
# Form labels that are rewritten, generations 8 and 9.
FORM_LABELS = {"Noice Face": "NoIce Face", "Alola Form": "Alolan Form"}
# Forms that settle the ratio, generations 8 and 9.
FORM_RATIOS = {"Male": "Always male", "Female": "Always female"}
# Rows dropped by key.
DROPPED_KEYS = {8: ["0503"]}

BASE_STATS = ["base_hp", "base_atk", "base_def", "base_sp_atk", "base_sp_def", "base_speed"]
EVS = ["hp_evs", "atk_evs", "def_evs", "sp_atk_evs", "sp_def_evs", "speed_evs"]


def of_gen(table: list[tuple], gen: int) -> list[tuple]:
    return [entry[2:] for entry in table if entry[0] <= gen <= entry[1]]
