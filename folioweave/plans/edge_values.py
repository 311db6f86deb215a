"""Fixed values of the evolution tables: enumerations, limits, rules, rows. Data only.

An entry that starts with two numbers holds for that range of generations.
"""

from __future__ import annotations

# Evolution methods in rank order; each has its own source page.
METHODS = ["level", "stone", "trade", "friendship", "status"]

# Game versions in rank order per generation.
GAMES = {
    6: ["X, Y", "Omega Ruby, Alpha Sapphire", ""],
    7: ["", "Ultra Sun, Ultra Moon", "Ultra Sun", "Ultra Moon", "Sun, Ultra Sun", "Moon, Ultra Moon", "Pokémon GO"],
    8: ["", "Brilliant Diamond, Shining Pearl", "Sword, Shield, Brilliant Diamond, Shining Pearl",
        "Legends: Arceus", "Brilliant Diamond, Shining Pearl, Legends: Arceus", "Sword, Shield", "Sword",
        "Shield", "Pokémon GO"],
    9: ["", "Scarlet", "Violet"],
}

# Last key of a generation, and the suffix pattern that does not belong to it.
KEY_LIMIT = {1: "0151", 2: "0251", 3: "0386", 4: "0493", 5: "0649", 6: "0721", 7: "0809", 8: "0905", 9: None}
NOT_IN_GEN = {
    1: r"\d{4}[a-z]", 2: r"\d{4}[a-z]", 3: r"\d{4}[a-z]",
    4: r"\d{4}[a-z]$", 5: r"\d{4}[a-z]$", 6: r"\d{4}[a-z]$",
    7: r"\d{4}[ghp]$", 8: r"\d{4}[p]$", 9: None,
}

# Columns that widen the duplicate key beyond (evolves_from, evolves_to).
EXTRA_KEYS = {6: ["stat", "location"], 7: ["stat", "versions"], 8: ["versions"], 9: ["versions"]}

# Output columns per generation.
COLUMNS = {
    1: ["evolves_from", "evolves_to", "method", "level", "item_used"],
    2: ["evolves_from", "evolves_to", "method", "level", "item_used", "item_held", "stat", "time_of_day",
        "other_condition"],
    3: ["evolves_from", "evolves_to", "method", "level", "item_used", "item_held", "stat", "time_of_day",
        "in_party", "other_condition"],
    4: ["evolves_from", "evolves_to", "method", "level", "item_used", "item_held", "stat", "time_of_day",
        "location", "move_learned", "gender", "in_party", "other_condition", "notes"],
    5: ["evolves_from", "evolves_to", "method", "level", "item_used", "item_held", "stat", "time_of_day",
        "location", "move_learned", "gender", "in_party", "other_condition", "notes"],
    6: ["evolves_from", "evolves_to", "method", "level", "item_used", "item_held", "stat", "time_of_day",
        "location", "move_learned", "gender", "in_party", "weather", "versions", "other_condition", "notes"],
}
for _gen in (7, 8, 9):
    COLUMNS[_gen] = COLUMNS[6]

# Texts cut from the condition cell, by where the cell's text goes.
STONE_CUTS = {
    2: [(", outside Alola", "")],
    3: [(", outside Alola", "")],
    4: [(", outside Alola", ""), (" in Gen 8", ""), ("+", "")],
    5: [(", outside Alola", ""), (" in Gen 8", ""), ("+", "")],
    6: [(", outside Alola", ""), (" in Gen 8", ""), ("+", "")],
    7: [("in Alola", ""), (" in Gen 8", ""), ("+", "")],
    8: [("outside Alola", "")],
    9: [("outside Alola", "")],
}
TRADE_CUTS = [("Kings Rock", "King's Rock")]
OTHER_CUTS = {
    7: [("in Alola", ""), ("outside Galar", ""), ("or Level 17 in Legends: Arceus", "")],
    8: [("outside Alola", ""), ("or Level 17 in Legends: Arceus", "")],
    9: [("outside Alola", ""), ("outside Galar", ""), ("in Legends: Arceus", "")],
}
for _gen in range(2, 7):
    OTHER_CUTS[_gen] = [("outside Alola", ""), ("outside Galar", ""), ("or Level 17 in Legends: Arceus", "")]
FIRST_GEN_CUTS = [("outside Alola", ""), ("outside Galar", ""), (", ", "")]

# Where the three "level up near/in" texts lead, per generation.
PLACE_TEXTS = ["level up in a Magnetic Field area", "level up near an Icy Rock", "level up near a Mossy Rock"]
PLACES = {
    4: ["Mt Coronet (any section)", "Route 217 (northeast)", "Eterna Forest (southwest)"],
    5: ["Chargestone Cave", "Twist Mountain (basement)", "Pinwheel Forest (southwest)"],
    6: ["New Mauville", "Shoal Cave (ice room, low tide)", "Petalburg Woods"],
    7: ["Vast Poni Canyon", "Mount Lanakila (inside cave)", "Lush Jungle"],
}
STONES = ["Thunder Stone", "Ice Stone", "Leaf Stone"]

# Fixed values: (first gen, last gen, text, target column, value), in order.
MOVES = [
    (2, 9, "Daytime", "time_of_day", "Daytime"),
    (2, 9, "Nighttime", "time_of_day", "Nighttime"),
    *[(g, g, t, "location", p) for g, ps in PLACES.items() for t, p in zip(PLACE_TEXTS, ps)],
    *[(9, 9, t, "item_used", s) for t, s in zip(PLACE_TEXTS, STONES)],
    (8, 8, "in Galar", "versions", "Sword, Shield"),
    (8, 8, "outside Galar", "location", "Outside Galar"),
    (8, 8, "in Legends: Arceus", "versions", "Legends: Arceus"),
    (4, 8, "in buildings", "location", "In buildings"),
    (4, 8, "in caves", "location", "In caves"),
    (4, 8, "in grass", "location", "In grass"),
    (4, 9, "Female", "gender", "Female"),
    (4, 9, "Male", "gender", "Male"),
    (6, 9, "during rain", "weather", "Rain"),
]

WORMADAM = ("Wormadam will take on Burmy's form at time of evolution, which can change based on the location of its "
            "most recent battle, but only if it actually leaves the ball.")
FEEBAS = ("Can still evolve by leveling a Feebas imported from earlier gen with max Beauty, despite being invisible")

# Rules before rows are added. (first gen, last gen, match, set)
FIRST_RULES = [
    (4, 8, {"evolves_from": ("starts", "0412")}, {"evolves_from": "0412"}),
    (4, 8, {"evolves_to": ("starts", "0413")}, {"notes": WORMADAM}),
    (5, 8, {"evolves_to": ("starts", "0555")}, {"evolves_to": "0555"}),
    (8, 8, {"evolves_from": "0554g"}, {"evolves_to": "0555g"}),
]

# Added rows per generation.
ADDED = {
    6: [
        {"evolves_from": "0082", "evolves_to": "0462", "method": "level", "location": "Route 13", "versions": "X, Y"},
        {"evolves_from": "0133", "evolves_to": "0470", "method": "level", "location": "Route 20", "versions": "X, Y"},
        {"evolves_from": "0133", "evolves_to": "0471", "method": "level", "location": "Frost Cavern", "versions": "X, Y"},
        {"evolves_from": "0299", "evolves_to": "0476", "method": "level", "location": "Route 13", "versions": "X, Y"},
        {"evolves_from": "0349", "evolves_to": "0350", "method": "level", "stat": "Beauty"},
    ],
    7: [
        *[{"evolves_from": a, "evolves_to": b, "method": "level", "location": "Blush Mountain",
           "versions": "Ultra Sun, Ultra Moon"} for a, b in (("0082", "0462"), ("0299", "0476"), ("0737", "0738"))],
        {"evolves_from": "0744", "evolves_to": "0745du", "method": "level", "level": "25", "time_of_day": "Dawn",
         "versions": "Ultra Moon", "other_condition": "Ability Own Tempo"},
    ],
    8: [
        *[{"evolves_from": a, "evolves_to": b, "method": "stone", "item_used": "Linking Cord",
           "versions": "Legends: Arceus"} for a, b in (("0064", "0065"), ("0067", "0068"), ("0075", "0076"))],
        {"evolves_from": "0082", "evolves_to": "0462", "method": "level", "location": "Mt Coronet (any section)",
         "versions": "Brilliant Diamond, Shining Pearl"},
        {"evolves_from": "0082", "evolves_to": "0462", "method": "level", "location": "Coronet Highlands (any section)",
         "versions": "Legends: Arceus"},
        {"evolves_from": "0093", "evolves_to": "0094", "method": "stone", "item_used": "Linking Cord",
         "versions": "Legends: Arceus"},
        {"evolves_from": "0133", "evolves_to": "0470", "method": "level", "location": "Eterna Forest (southwest)",
         "versions": "Brilliant Diamond, Shining Pearl"},
        {"evolves_from": "0133", "evolves_to": "0470", "method": "level", "location": "The Heartwood (west)",
         "versions": "Legends: Arceus"},
        {"evolves_from": "0133", "evolves_to": "0471", "method": "level", "location": "Route 217 (northeast)",
         "versions": "Brilliant Diamond, Shining Pearl"},
        {"evolves_from": "0133", "evolves_to": "0471", "method": "level", "location": "Icepeak Cavern",
         "versions": "Legends: Arceus"},
        {"evolves_from": "0155", "evolves_to": "0156h", "method": "level", "level": "17", "versions": "Legends: Arceus"},
        {"evolves_from": "0299", "evolves_to": "0476", "method": "level", "location": "Mt Coronet (any section)",
         "versions": "Brilliant Diamond, Shining Pearl"},
        {"evolves_from": "0299", "evolves_to": "0476", "method": "level", "location": "Coronet Highlands (any section)",
         "versions": "Legends: Arceus"},
        {"evolves_from": "0854", "evolves_to": "0855", "method": "stone", "item_used": "Chipped Pot",
         "versions": "Sword, Shield", "other_condition": "Antique form"},
    ],
    9: [
        {"evolves_from": "0075", "evolves_to": "0076", "method": "stone", "item_used": "Linking Cord"},
        {"evolves_from": "0075a", "evolves_to": "0076a", "method": "stone", "item_used": "Linking Cord"},
        {"evolves_from": "0093", "evolves_to": "0094", "method": "stone", "item_used": "Linking Cord"},
        {"evolves_from": "0854", "evolves_to": "0855", "method": "stone", "item_used": "Chipped Pot",
         "other_condition": "Antique form"},
        {"evolves_from": "0999ro", "evolves_to": "1000", "method": "level"},
        {"evolves_from": "1012", "evolves_to": "1013", "method": "stone", "item_used": "Masterpiece Teacup",
         "other_condition": "Artisan form"},
    ],
}

# Rows copied once per size, generations 6 to 9.
COPIED_FROM = "0710av"
COPIES = [("0710sm", "0711sm"), ("0710la", "0711la"), ("0710su", "0711su")]

# Forms that generation 9 leaves out.
DROPPED_FORMS = {9: ["Two-Segment Form", "Family of Four"]}

# Rules after rows were added and copied, before duplicates go.
SECOND_RULES = [
    (9, 9, {"evolves_from": "0206"},
     {"evolves_to": "0982", "evolves_to_form": "", "other_condition": "after Hyper Drill learned",
      "notes": "Can have two or three (1/100 chance) segments. Difference is purely aesthetic."}),
    (7, 7, {"evolves_to_form": "Midday Form"}, {"evolves_to": "0745md", "versions": "Sun, Ultra Sun"}),
    (7, 7, {"evolves_to_form": "Midnight Form"}, {"evolves_to": "0745mn", "versions": "Moon, Ultra Moon"}),
    (7, 7, {"evolves_to_form": "Dusk Form"},
     {"evolves_from": "0744", "evolves_from_form": "", "time_of_day": "Dusk", "versions": "Ultra Sun",
      "other_condition": "Ability Own Tempo"}),
    (8, 9, {"evolves_to_form": "Midday Form"}, {"evolves_to": "0745md"}),
    (8, 9, {"evolves_to_form": "Midnight Form"}, {"evolves_to": "0745mn"}),
    (8, 9, {"evolves_to_form": "Dusk Form"},
     {"evolves_from": "0744", "evolves_from_form": "", "time_of_day": "Dusk", "other_condition": "Ability Own Tempo"}),
    (9, 9, {"evolves_from": "0924"},
     {"evolves_to": "0925", "evolves_to_form": "", "other_condition": "",
      "notes": "Can be a family of three (1/100 chance) or four. Difference is purely aesthetic."}),
]

# Targets whose method counts as the first rank in generation 7.
FIRST_RANK = {7: ["0462", "0476", "0738"]}

# Rules before conditions are moved.
BEFORE_MOVES = [
    (3, 4, {"evolves_to": "0350"}, {"method": "level", "item_held": "", "stat": "Beauty"}),
    (5, 5, {"evolves_to": "0350"}, {"item_held": "Prism Scale", "notes": FEEBAS}),
    (6, 6, {"evolves_to": "0350", "method": "trade"}, {"item_held": "Prism Scale"}),
    (7, 9, {"evolves_to": "0350"}, {"item_held": "Prism Scale", "notes": FEEBAS}),
    (7, 7, {"evolves_to": "0740"}, {"method": "level", "item_used": "", "location": "Mount Lanakila"}),
    (8, 8, {"evolves_to": "0892ra"}, {"method": "status", "item_used": "", "other_condition": "Complete the Tower of Water"}),
    (8, 8, {"evolves_to": "0892si"}, {"method": "status", "item_used": "", "other_condition": "Complete the Tower of Darkness"}),
    (9, 9, {"evolves_to": "0892ra"}, {"method": "stone", "item_used": "Scroll of Waters"}),
    (9, 9, {"evolves_to": "0892si"}, {"method": "stone", "item_used": "Scroll of Darkness"}),
]

RECOIL = {"method": "level", "other_condition": "Receive 294 recoil damage in battle without fainting"}

# Rules after conditions were moved.
AFTER_MOVES = [
    (8, 8, {"evolves_to": "0156"}, {"versions": "Sword, Shield, Brilliant Diamond, Shining Pearl"}),
    (9, 9, {"evolves_to": "0156"}, {"other_condition": ""}),
    (9, 9, {"evolves_to": "0476"}, {"method": "item"}),
    (5, 9, {"evolves_to": "0589"}, {"item_held": "", "other_condition": "Trade with Shelmet"}),
    (5, 9, {"evolves_to": "0617"}, {"item_held": "", "other_condition": "Trade with Karrablast"}),
    (6, 7, {"evolves_to": "0687"}, {"other_condition": "Hold console upside down"}),
    (8, 9, {"evolves_to": "0687"}, {"other_condition": "Hold console upside down (handheld mode only)"}),
    (6, 7, {"evolves_to": "0700"}, {"stat": "Affection", "other_condition": "after Fairy-type move learned"}),
    (8, 9, {"evolves_to": "0700"}, {"stat": "Friendship", "other_condition": "after Fairy-type move learned"}),
    (9, 9, {"evolves_to": "0740"}, {"item_used": "Ice Stone"}),
    (7, 7, {"evolves_to": "0791"}, {"versions": "Sun, Ultra Sun", "other_condition": ""}),
    (7, 7, {"evolves_to": "0792"}, {"versions": "Moon, Ultra Moon", "other_condition": ""}),
    (8, 8, {"evolves_to": "0791"}, {"versions": "Sword", "other_condition": ""}),
    (8, 8, {"evolves_to": "0792"}, {"versions": "Shield", "other_condition": ""}),
    (9, 9, {"evolves_to": "0791"}, {"versions": "Scarlet", "other_condition": ""}),
    (9, 9, {"evolves_to": "0792"}, {"versions": "Violet", "other_condition": ""}),
    (7, 7, {"evolves_to": "0804"}, {"versions": "Ultra Sun, Ultra Moon"}),
    (7, 9, {"evolves_to": "0809"}, {"versions": "Pokémon GO", "other_condition": "400 Meltan Candies"}),
    *[(g, g, {"location": p}, {"method": "level", "item_used": ""}) for g in (4, 5, 7) for p in PLACES[g]],
    *[(6, 6, {"location": p}, {"method": "level", "item_used": "", "versions": "Omega Ruby, Alpha Sapphire"})
      for p in PLACES[6]],
    (8, 9, {"evolves_to": "0849am"},
     {"other_condition": "Adamant, Brave, Docile, Hardy, Hasty, Impish, Jolly, Lax, Naive, Naughty, Rash, Quirky, Sassy Nature"}),
    (8, 9, {"evolves_to": "0849lo"},
     {"other_condition": "Bashful, Bold, Calm, Careful, Gentle, Lonely, Mild, Modest, Quiet, Relaxed, Serious, Timid Nature"}),
    (8, 9, {"evolves_to": "0855", "item_used": "Cracked Pot"}, {"other_condition": "Phony form"}),
    (8, 8, {"evolves_to": "0855"}, {"versions": ""}),
    (8, 8, {"evolves_to": "0867"},
     {"location": "Dusty Bowl", "versions": "Sword, Shield",
      "other_condition": "Take 49+ damage taken in one battle, then walk under stone sculpture"}),
    (8, 9, {"evolves_to": "0869"}, {"other_condition": "Spin around holding a Sweet item"}),
    (8, 8, {"evolves_to": "0899"}, {"versions": "Legends: Arceus"}),
    (8, 8, {"evolves_to": "0901"},
     {"item_used": "Peat Block", "weather": "Full moon", "versions": "Legends: Arceus",
      "notes": "The moon doesn't need to be visible"}),
    (8, 9, {"evolves_to": "0902fe"}, RECOIL),
    (8, 9, {"evolves_to": "0902ma"}, RECOIL),
    (8, 9, {"evolves_to": "0903"}, {"method": "level", "item_used": "", "item_held": "Razor Claw"}),
    (8, 8, {"evolves_to": "0904"}, {"versions": "Legends: Arceus"}),
    (9, 9, {"evolves_to": "0904"}, {"method": "level", "move_learned": "Barb Barrage", "other_condition": ""}),
    (9, 9, {"evolves_to": "0964ze"}, {"other_condition": "With another player in the Union Circle"}),
    (9, 9, {"evolves_to": "1000"}, {"other_condition": "Collect 999 Gimmighoul Coins"}),
    (9, 9, {"evolves_to": "1013", "item_used": "Unremarkable Teacup"}, {"other_condition": "Counterfeit form"}),
    (8, 8, {"location": "Outside Galar"}, {"location": "", "versions": "Brilliant Diamond, Shining Pearl, Legends: Arceus"}),
    (8, 8, {"item_used": ("ends", "Magnetic Field area")},
     {"method": "item", "item_used": "Thunder Stone", "versions": "Sword, Shield"}),
    (8, 8, {"item_used": ("ends", "Icy Rock")}, {"method": "item", "item_used": "Ice Stone", "versions": "Sword, Shield"}),
    (8, 8, {"item_used": ("ends", "Mossy Rock")}, {"method": "item", "item_used": "Leaf Stone", "versions": "Sword, Shield"}),
    (8, 8, {"evolves_to": "0738"}, {"versions": ""}),
]

STAY = "Must be evolved in other generation and traded to "

# Rules after texts were moved to their columns.
LAST_RULES = [
    (3, 9, {"evolves_to": "0292"}, {"in_party": "Empty spot", "other_condition": "Pokéball in bag"}),
    (4, 8, {"evolves_to": "0226"}, {"method": "level", "in_party": "Remoraid", "other_condition": ""}),
    (9, 9, {"evolves_to": "0226"}, {"in_party": "Remoraid", "other_condition": ""}),
    (6, 9, {"evolves_to": "0675"}, {"in_party": "Dark-type Pokémon", "other_condition": ""}),
    (9, 9, {"evolves_to": ["0226", "0979", "0983", "1000"]}, {"method": "level"}),
    (7, 7, {"evolves_to": ["0026", "0103", "0105"]},
     {"method": "N/A", "level": "", "item_used": "", "other_condition": STAY + "SMUSUM"}),
    (8, 8, {"evolves_to": ["0026a", "0103a", "0105a"]},
     {"method": "N/A", "level": "", "item_used": "", "other_condition": STAY + "SwSh"}),
    (9, 9, {"evolves_to": ["0026a", "0103a", "0110g", "0157h", "0503h", "0549h", "0628h", "0705h", "0713h", "0724h",
                           "0899", "0901"]},
     {"method": "N/A", "level": "", "item_used": "", "other_condition": STAY + "SV"}),
    (9, 9, {"evolves_to": "0901"}, {"notes": "Ursaluna can also be caught in the wild"}),
    (1, 9, {"method": "stone"}, {"method": "item"}),
    (7, 9, {"method": "status"}, {"method": "miscellaneous"}),
    (2, 9, {"method": "friendship"}, {"method": "level", "stat": "Friendship"}),
]

# Targets that do not exist in a generation.
EXCLUDED = {
    8: ["0020a", "0075a", "0076a", "0089a", "0496", "0497", "0499", "0500", "0503", "0505", "0512", "0514", "0516",
        "0523", "0541", "0542", "0581", "0586", "0603", "0604", "0651", "0652", "0654", "0655", "0657", "0658",
        "0665", "0666", "0668", "0670", "0671", "0673", "0732", "0733", "0735", "0740"],
    9: ["0011", "0012", "0014", "0015", "0017", "0018", "0020", "0020a", "0022", "0030", "0031", "0033", "0034",
        "0042", "0047", "0064", "0065", "0067", "0068", "0078", "0078g", "0099", "0105", "0105a", "0119", "0121",
        "0122", "0122g", "0124", "0139", "0141", "0166", "0169", "0176", "0178", "0202", "0208", "0224", "0226",
        "0264", "0264g", "0266", "0267", "0268", "0269", "0277", "0291", "0292", "0294", "0295", "0301", "0305",
        "0306", "0310", "0315", "0319", "0321", "0344", "0346", "0348", "0364", "0365", "0367", "0368", "0400",
        "0407", "0413pl", "0413sa", "0413tr", "0414", "0421", "0428", "0432", "0452", "0463", "0465", "0468", "0505",
        "0507", "0508", "0510", "0512", "0514", "0516", "0518", "0520", "0521", "0525", "0526", "0528", "0536",
        "0537", "0544", "0545", "0555g", "0555st", "0558", "0563", "0565", "0567", "0569", "0583", "0584", "0589",
        "0593", "0598", "0600", "0601", "0606", "0617", "0660", "0675", "0680", "0681sh", "0683", "0685", "0689",
        "0695", "0697", "0699", "0711av", "0711la", "0711sm", "0711su", "0756", "0760", "0768", "0773", "0804",
        "0809", "0825", "0826", "0828", "0830", "0832", "0836", "0851", "0853", "0862", "0864", "0865", "0866",
        "0867"],
}

# Rows that generation 8 leaves out by two columns.
DROPPED_ROWS = {8: {"evolves_to": "0476", "method": "miscellaneous"}}


def of_gen(table: list[tuple], gen: int) -> list[tuple]:
    """Entries of a ranged table that hold for a generation, without their range."""
    return [entry[2:] for entry in table if entry[0] <= gen <= entry[1]]
