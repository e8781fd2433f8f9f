"""Constants the results depend on. All of them can be overridden by arguments."""

# Bounding boxes (lat_min, lat_max, lon_min, lon_max), inclusive
BBOX_STRICT = (41.0, 51.5, -5.0, 10.0)
BBOX_WIDE = (41.0, 51.5, -5.5, 10.5)

# patterns
DEPARTMENT_PATTERN = r"^(0[1-9]|[1-8][0-9]|9[0-5]|2A|2B)$"
DEPARTMENT_PATTERN_OVERSEAS = r"^(0[1-9]|[1-8][0-9]|9[0-5]|2A|2B|97[1-6])$"
COMMUNE_PATTERN = r"([0-9A-B]{5})"

# Spatial parameters
EARTH_RADIUS_KM = 6371.0
STOP_GRID_DEG, STOP_SPAN, STOP_RADIUS_KM = 0.01, 1, 1.0
ROAD_GRID_DEG, ROAD_SPAN = 0.02, 2
CLUB_GRID_DEG, CLUB_SPAN, CLUB_RADIUS_KM = 0.05, 3, 5.0
CLUB_DISTANCE_FALLBACK_KM = 50.0
ROAD_DISTANCE_FALLBACK_KM = 50.0
ROAD_DISTANCE_PENALTY_KM = 5.0

# Scoring parameters
FAR_CLUB_KM, FAR_CLUB_BONUS = 10.0, 0.10
PRICE_CAP = 3000.0
PRICE_FALLBACK = 1500.0
DEMAND_FALLBACK = 50
TOP_CELLS = 1000
TOP_PER_WEIGHT_SET = 500
MIN_CELLS_PER_ZONE = 3

# Weight sets (competition, access, property, income, target share)
WEIGHT_SETS = {
    "base": (0.30, 0.25, 0.20, 0.15, 0.10),
    "conc_plus": (0.40, 0.20, 0.15, 0.15, 0.10),
    "access_plus": (0.20, 0.35, 0.20, 0.15, 0.10),
    "immo_plus": (0.25, 0.20, 0.30, 0.15, 0.10),
    "demo_plus": (0.25, 0.20, 0.15, 0.15, 0.25),
}
ACCESS_WEIGHTS = (0.6, 0.4)

# Label thresholds, highest first for ">" and lowest first for "<="
GRADES = [(0.8, "A+"), (0.7, "A"), (0.6, "B"), (0.5, "C")]
GRADE_OTHER = "D"
COMPETITION_LABELS = [(0, "Zone blanche"), (2, "Faible"), (5, "Concurrentiel")]
COMPETITION_OTHER = "Sature"
TIERS = [(0.75, "Premium"), (0.65, "Excellent"), (0.55, "Bon")]
TIER_OTHER = "Correct"
SATURATED_ABOVE = 5
POPULATION_PER_UNIT = 25.0

# Live competition pressure
IMPACT_RADIUS_KM = 55.0
IMPACT_EXPONENT = 1.25
IMPACT_GRID_DEG, IMPACT_SPAN = 0.5, 2
PRESSURE_MAX = 0.45
BASE_INTENSITY = (0.002, 0.008)
LIVE_INTENSITY = (0.035, 0.16)
COURTS_DEFAULT, COURTS_MIN, COURTS_MAX = 2.0, 1.0, 12.0
SCORE_MIN, SCORE_MAX = 0.02, 1.0
SCORE_DEFAULT = 0.35
SCORE_DELTA_VISIBLE = 0.008

# Event types
EVENT_TYPES = ("club_created", "club_updated", "club_deleted")
DELETE_EVENT = "club_deleted"

# Words read as booleans
TRUE_WORDS = ("true", "1", "yes", "oui")
FALSE_WORDS = ("false", "0", "no", "non")

# Region aliases
REGION_ALIASES = {"centre val de loire": "centre"}

# The 22 former metropolitan regions and their departments
REGION_DEPARTMENTS = {
    "alsace": ["67", "68"],
    "aquitaine": ["24", "33", "40", "47", "64"],
    "auvergne": ["03", "15", "43", "63"],
    "basse normandie": ["14", "50", "61"],
    "bourgogne": ["21", "58", "71", "89"],
    "bretagne": ["22", "29", "35", "56"],
    "centre": ["18", "28", "36", "37", "41", "45"],
    "champagne ardenne": ["08", "10", "51", "52"],
    "corse": ["2A", "2B"],
    "franche comte": ["25", "39", "70", "90"],
    "haute normandie": ["27", "76"],
    "ile de france": ["75", "77", "78", "91", "92", "93", "94", "95"],
    "languedoc roussillon": ["11", "30", "34", "48", "66"],
    "limousin": ["19", "23", "87"],
    "lorraine": ["54", "55", "57", "88"],
    "midi pyrenees": ["09", "12", "31", "32", "46", "65", "81", "82"],
    "nord pas de calais": ["59", "62"],
    "pays de la loire": ["44", "49", "53", "72", "85"],
    "picardie": ["02", "60", "80"],
    "poitou charentes": ["16", "17", "79", "86"],
    "provence alpes cote d azur": ["04", "05", "06", "13", "83", "84"],
    "rhone alpes": ["01", "07", "26", "38", "42", "69", "73", "74"],
}

# Default name and region of an unknown department, order of the regions
UNKNOWN_DEPARTMENT = "Departement "
UNKNOWN_REGION = "Autres"
REGION_ORDER = [
    "Auvergne-Rhone-Alpes", "Bourgogne-Franche-Comte", "Bretagne", "Centre-Val de Loire", "Corse",
    "Grand Est", "Hauts-de-France", "Ile-de-France", "Normandie", "Nouvelle-Aquitaine", "Occitanie",
    "Pays de la Loire", "Provence-Alpes-Cote d'Azur", "Autres",
]

# Department code -> (name, present region)
DEPARTMENTS = {
    "01": ("Ain", "Auvergne-Rhone-Alpes"),
    "02": ("Aisne", "Hauts-de-France"),
    "03": ("Allier", "Auvergne-Rhone-Alpes"),
    "04": ("Alpes-de-Haute-Provence", "Provence-Alpes-Cote d'Azur"),
    "05": ("Hautes-Alpes", "Provence-Alpes-Cote d'Azur"),
    "06": ("Alpes-Maritimes", "Provence-Alpes-Cote d'Azur"),
    "07": ("Ardeche", "Auvergne-Rhone-Alpes"),
    "08": ("Ardennes", "Grand Est"),
    "09": ("Ariege", "Occitanie"),
    "10": ("Aube", "Grand Est"),
    "11": ("Aude", "Occitanie"),
    "12": ("Aveyron", "Occitanie"),
    "13": ("Bouches-du-Rhone", "Provence-Alpes-Cote d'Azur"),
    "14": ("Calvados", "Normandie"),
    "15": ("Cantal", "Auvergne-Rhone-Alpes"),
    "16": ("Charente", "Nouvelle-Aquitaine"),
    "17": ("Charente-Maritime", "Nouvelle-Aquitaine"),
    "18": ("Cher", "Centre-Val de Loire"),
    "19": ("Correze", "Nouvelle-Aquitaine"),
    "21": ("Cote-d'Or", "Bourgogne-Franche-Comte"),
    "22": ("Cotes-d'Armor", "Bretagne"),
    "23": ("Creuse", "Nouvelle-Aquitaine"),
    "24": ("Dordogne", "Nouvelle-Aquitaine"),
    "25": ("Doubs", "Bourgogne-Franche-Comte"),
    "26": ("Drome", "Auvergne-Rhone-Alpes"),
    "27": ("Eure", "Normandie"),
    "28": ("Eure-et-Loir", "Centre-Val de Loire"),
    "29": ("Finistere", "Bretagne"),
    "2A": ("Corse-du-Sud", "Corse"),
    "2B": ("Haute-Corse", "Corse"),
    "30": ("Gard", "Occitanie"),
    "31": ("Haute-Garonne", "Occitanie"),
    "32": ("Gers", "Occitanie"),
    "33": ("Gironde", "Nouvelle-Aquitaine"),
    "34": ("Herault", "Occitanie"),
    "35": ("Ille-et-Vilaine", "Bretagne"),
    "36": ("Indre", "Centre-Val de Loire"),
    "37": ("Indre-et-Loire", "Centre-Val de Loire"),
    "38": ("Isere", "Auvergne-Rhone-Alpes"),
    "39": ("Jura", "Bourgogne-Franche-Comte"),
    "40": ("Landes", "Nouvelle-Aquitaine"),
    "41": ("Loir-et-Cher", "Centre-Val de Loire"),
    "42": ("Loire", "Auvergne-Rhone-Alpes"),
    "43": ("Haute-Loire", "Auvergne-Rhone-Alpes"),
    "44": ("Loire-Atlantique", "Pays de la Loire"),
    "45": ("Loiret", "Centre-Val de Loire"),
    "46": ("Lot", "Occitanie"),
    "47": ("Lot-et-Garonne", "Nouvelle-Aquitaine"),
    "48": ("Lozere", "Occitanie"),
    "49": ("Maine-et-Loire", "Pays de la Loire"),
    "50": ("Manche", "Normandie"),
    "51": ("Marne", "Grand Est"),
    "52": ("Haute-Marne", "Grand Est"),
    "53": ("Mayenne", "Pays de la Loire"),
    "54": ("Meurthe-et-Moselle", "Grand Est"),
    "55": ("Meuse", "Grand Est"),
    "56": ("Morbihan", "Bretagne"),
    "57": ("Moselle", "Grand Est"),
    "58": ("Nievre", "Bourgogne-Franche-Comte"),
    "59": ("Nord", "Hauts-de-France"),
    "60": ("Oise", "Hauts-de-France"),
    "61": ("Orne", "Normandie"),
    "62": ("Pas-de-Calais", "Hauts-de-France"),
    "63": ("Puy-de-Dome", "Auvergne-Rhone-Alpes"),
    "64": ("Pyrenees-Atlantiques", "Nouvelle-Aquitaine"),
    "65": ("Hautes-Pyrenees", "Occitanie"),
    "66": ("Pyrenees-Orientales", "Occitanie"),
    "67": ("Bas-Rhin", "Grand Est"),
    "68": ("Haut-Rhin", "Grand Est"),
    "69": ("Rhone", "Auvergne-Rhone-Alpes"),
    "70": ("Haute-Saone", "Bourgogne-Franche-Comte"),
    "71": ("Saone-et-Loire", "Bourgogne-Franche-Comte"),
    "72": ("Sarthe", "Pays de la Loire"),
    "73": ("Savoie", "Auvergne-Rhone-Alpes"),
    "74": ("Haute-Savoie", "Auvergne-Rhone-Alpes"),
    "75": ("Paris", "Ile-de-France"),
    "76": ("Seine-Maritime", "Normandie"),
    "77": ("Seine-et-Marne", "Ile-de-France"),
    "78": ("Yvelines", "Ile-de-France"),
    "79": ("Deux-Sevres", "Nouvelle-Aquitaine"),
    "80": ("Somme", "Hauts-de-France"),
    "81": ("Tarn", "Occitanie"),
    "82": ("Tarn-et-Garonne", "Occitanie"),
    "83": ("Var", "Provence-Alpes-Cote d'Azur"),
    "84": ("Vaucluse", "Provence-Alpes-Cote d'Azur"),
    "85": ("Vendee", "Pays de la Loire"),
    "86": ("Vienne", "Nouvelle-Aquitaine"),
    "87": ("Haute-Vienne", "Nouvelle-Aquitaine"),
    "88": ("Vosges", "Grand Est"),
    "89": ("Yonne", "Bourgogne-Franche-Comte"),
    "90": ("Territoire de Belfort", "Bourgogne-Franche-Comte"),
    "91": ("Essonne", "Ile-de-France"),
    "92": ("Hauts-de-Seine", "Ile-de-France"),
    "93": ("Seine-Saint-Denis", "Ile-de-France"),
    "94": ("Val-de-Marne", "Ile-de-France"),
    "95": ("Val-d'Oise", "Ile-de-France"),
}
