"""Vocabularies, factors and severities that results depend on."""

# Qualifier spellings and what they mean.
QUALIFIERS = {
    "": "reported", "=": "reported", "reported": "reported", "exact": "reported",
    "~": "approximate", "approx": "approximate", "approximate": "approximate",
    "<": "lt", "lt": "lt", "<=": "le", "≤": "le", "le": "le", ">": "gt", "gt": "gt", ">=": "ge", "≥": "ge", "ge": "ge",
    "bdl": "bdl", "below detection limit": "bdl", "l": "bdl", "lod": "bdl", "<lod": "bdl",
    "loq": "loq", "<loq": "loq", "bql": "loq", "below quantitation limit": "loq", "below quantification limit": "loq",
    "g": "gt", "nd": "nd", "n.d.": "nd", "not detected": "nd", "n": "nd", "trace": "trace", "tr": "trace",
}
CENSORED = ("lt", "le", "gt", "ge", "bdl", "loq", "nd", "trace")

# Reasons for a missing value.
MISSING_REASONS = {
    "not_reported": "not_reported", "not reported": "not_reported", "nr": "not_reported",
    "not_analyzed": "not_analyzed", "not analysed": "not_analyzed", "not analyzed": "not_analyzed", "na": "not_analyzed", "n/a": "not_analyzed",
    "insufficient_sample": "insufficient_sample", "insufficient sample": "insufficient_sample", "ins": "insufficient_sample",
    "invalid_value": "invalid_value", "invalid value": "invalid_value", "unknown": "unknown",
}

# Media.
MEDIA = {
    "rock": "rock", "rocks": "rock", "bedrock": "rock", "岩石": "rock",
    "soil": "soil", "soils": "soil", "topsoil": "soil", "subsoil": "soil", "土壤": "soil",
    "sediment": "sediment", "sediments": "sediment", "stream sediment": "sediment", "stream_sediment": "sediment", "河流沉积物": "sediment", "沉积物": "sediment",
    "water": "water", "groundwater": "water", "surface water": "water", "surface_water": "water", "seawater": "water", "porewater": "water", "river water": "water", "水": "water", "水体": "water",
    "mineral": "mineral", "minerals": "mineral", "矿物": "mineral",
    "concentrate": "concentrate", "heavy mineral concentrate": "concentrate", "精矿": "concentrate",
}
SOLID_MEDIA = ("rock", "soil", "sediment", "mineral", "concentrate")

# Unit factors to mg/kg (solids) and ug/L (water), molar masses, and ratio units that water can't take.
SOLID_FACTORS = {"mg/kg": 1.0, "ppm": 1.0, "ug/g": 1.0, "g/t": 1.0, "wt%": 10000.0, "ppb": 0.001, "ug/kg": 0.001, "ng/g": 0.001, "g/kg": 1000.0, "mg/g": 1000.0}
WATER_FACTORS = {"ug/l": 1.0, "mg/l": 1000.0, "ng/l": 0.001, "g/l": 1000000.0}
MOLAR_MASSES = {"As": 74.921595, "Cu": 63.546, "Fe": 55.845, "Ni": 58.6934, "Pb": 207.2, "Zn": 65.38}
AMBIGUOUS_IN_WATER = ("ppm", "ppb", "wt%", "%", "percent", "mg/kg", "ug/kg", "g/kg", "ug/g", "ng/g", "mg/g")
UNIT_ALIASES = {"wtpercent": "wt%", "wt.%": "wt%", "mgkg": "mg/kg", "ugkg": "ug/kg", "gkg": "g/kg", "ugg": "ug/g", "ngg": "ng/g", "mgg": "mg/g", "gt": "g/t", "ugl": "ug/l", "mgl": "mg/l", "ngl": "ng/l", "gl": "g/l"}
#: Spellings replaced in this order before white space goes.
UNIT_WORDS = (
    ("μ", "u"), ("µ", "u"), ("−", "-"), ("·", ""),
    ("micrograms", "ug"), ("microgram", "ug"), ("mcg", "ug"), ("milligrams", "mg"), ("milligram", "mg"), ("nanograms", "ng"), ("nanogram", "ng"),
    ("grams", "g"), ("gram", "g"), ("kilograms", "kg"), ("kilogram", "kg"), ("litres", "l"), ("liters", "l"), ("litre", "l"), ("liter", "l"), ("tonne", "t"),
    ("weightpercent", "wt%"), ("weight%", "wt%"), ("wt.%", "wt%"),
)

# Elements by name, atomic weights, and oxides (formula, element, atoms of it, atoms of oxygen).
ELEMENT_NAMES = {"arsenic": "As", "lead": "Pb", "zinc": "Zn", "copper": "Cu", "nickel": "Ni", "chromium": "Cr", "cadmium": "Cd", "mercury": "Hg", "iron": "Fe", "manganese": "Mn", "cobalt": "Co", "silicon": "Si", "aluminium": "Al", "aluminum": "Al", "calcium": "Ca", "magnesium": "Mg", "sodium": "Na", "potassium": "K", "phosphorus": "P", "titanium": "Ti", "uranium": "U", "gold": "Au", "silver": "Ag"}
ELEMENTS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe "
    "Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U"
).split()
ATOMIC_WEIGHTS = {"O": 15.999, "Na": 22.98976928, "Mg": 24.305, "Al": 26.9815385, "Si": 28.085, "P": 30.973761998, "K": 39.0983, "Ca": 40.078, "Ti": 47.867, "Cr": 51.9961, "Mn": 54.938044, "Fe": 55.845, "Co": 58.933194, "Ni": 58.6934, "Cu": 63.546, "Zn": 65.38}
OXIDES = {
    "SIO2": ("SiO2", "Si", 1, 2), "TIO2": ("TiO2", "Ti", 1, 2), "AL2O3": ("Al2O3", "Al", 2, 3), "FEO": ("FeO", "Fe", 1, 1), "FE2O3": ("Fe2O3", "Fe", 2, 3),
    "MNO": ("MnO", "Mn", 1, 1), "MGO": ("MgO", "Mg", 1, 1), "CAO": ("CaO", "Ca", 1, 1), "NA2O": ("Na2O", "Na", 2, 1), "K2O": ("K2O", "K", 2, 1),
    "P2O5": ("P2O5", "P", 2, 5), "CR2O3": ("Cr2O3", "Cr", 2, 3), "COO": ("CoO", "Co", 1, 1), "NIO": ("NiO", "Ni", 1, 1), "CUO": ("CuO", "Cu", 1, 1), "ZNO": ("ZnO", "Zn", 1, 1),
}

# Method families by the words in a method, first match wins.
METHOD_PATTERNS = (
    ("icp_ms", ("icp-ms", "icp ms", "icpms")),
    ("icp_oes", ("icp-oes", "icp oes", "icp-aes", "icp aes")),
    ("xrf", ("xrf", "x-ray fluorescence", "x ray fluorescence")),
    ("aas", ("aas", "atomic absorption")),
    ("inaa", ("inaa", "neutron activation")),
    ("idms", ("idms", "isotope dilution")),
    ("ion_chromatography", ("ion chromatography",)),
)
WGS84 = ("epsg:4326", "4326", "wgs84", "wgs 84", "ogc:crs84", "crs84")

# Source tiers and their scores.
TIER_SCORES = {"official_curated": 1.0, "government": 0.95, "peer_reviewed": 0.9, "institutional_repository": 0.8, "author_supplement": 0.75, "aggregator": 0.55, "unknown": 0.3}
TIERS = {
    "official": "official_curated", "official curated": "official_curated", "official_curated": "official_curated",
    "government": "government", "gov": "government", "government agency": "government",
    "peer reviewed": "peer_reviewed", "peer-reviewed": "peer_reviewed", "peer_reviewed": "peer_reviewed", "journal": "peer_reviewed",
    "institutional repository": "institutional_repository", "institutional_repository": "institutional_repository",
    "author supplement": "author_supplement", "author_supplement": "author_supplement", "supplement": "author_supplement",
    "aggregator": "aggregator", "unknown": "unknown",
}

# Flags by severity; any other flag is a warning.
ERROR_FLAGS = (
    "MISSING_VALUE", "INVALID_NUMERIC_VALUE", "INVALID_MISSING_REASON", "INVALID_DETECTION_LIMIT", "NEGATIVE_CONCENTRATION", "UNSUPPORTED_UNIT",
    "UNSUPPORTED_MOLAR_MASS", "UNSUPPORTED_MOLAR_SPECIES", "UNSUPPORTED_SPECIES_CONVERSION", "OXIDE_ELEMENT_MISMATCH", "AMBIGUOUS_AQUEOUS_RATIO_UNIT",
    "INVALID_COORDINATE", "UNSUPPORTED_SOURCE_CRS", "INVALID_COORDINATE_POLICY", "DEPTH_RANGE_INVALID", "INVALID_GEOLOGIC_DISTANCE",
    "INVALID_QUANTITATION_LIMIT", "BATCH_QC_FAILED",
)
INFO_FLAGS = ("CENSORED_VALUE", "INFERRED_ELEMENT_FROM_OXIDE", "GENERATED_RECORD_ID", "PLATFORM_CRS_POLICY_APPLIED", "REGISTERED_CRS_POLICY_APPLIED")


def oxide_fraction(key: str) -> float:
    """Mass fraction of the element in an oxide."""
    _, element, n, oxygen = OXIDES[key]
    own = ATOMIC_WEIGHTS[element] * n
    return own / (own + ATOMIC_WEIGHTS["O"] * oxygen)

# Rock families with naturally high backgrounds of some elements, by words of a rock's name, and element suites.
HIGH_BACKGROUND = (
    (("ULTRAMAFIC", "PERIDOTITE", "SERPENTIN", "DUNITE", "PYROXENITE", "KOMATIITE"), ("Ni", "Cr", "Co")),
    (("BASALT", "GABBRO", "DOLERITE", "DIABASE", "AMPHIBOLITE", "GREENSTONE"), ("Ni", "Cr", "Cu", "Co", "V")),
    (("BLACK SHALE", "SHALE", "SCHIST"), ("As", "Mo", "U", "V", "Zn")),
)
CHALCOPHILE = ("Pb", "Zn", "Cd", "Cu", "Hg", "As", "Sb")
MAFIC = ("Ni", "Cr", "Co", "V")
# Sample types of the two layers of a medium.
LAYERS = {
    "soil": (("soil_topsoil", "soil_a_horizon", "soil_humus", "soil_organic_litter", "soil_surface"), ("soil_subsoil", "soil_c_horizon")),
    "sediment": (("sediment_outlet_top", "sediment_marine_surface"), ("sediment_outlet_bottom", "sediment_marine_core")),
}
USABLE_TIERS = ("analysis_ready", "single_lineage_ready")
