"""Word lists, tables and patterns that results depend on, in their natural order."""

# ---- fixed values: slots (name, default phase) ----
SLOTS = [("aqueous_monomer", "aqueous"), ("organic_monomer", "organic"), ("additive", "unknown"), ("modifier", "unknown"), ("test_nacl", "aqueous")]

# ---- fixed values: densities of solvents and of pure solutes, g/mL ----
SOLVENT_DENSITY = {
    "water": 1.000, "hexane": 0.659, "n-hexane": 0.659, "cyclohexane": 0.779, "heptane": 0.684, "octane": 0.703, "isooctane": 0.692,
    "toluene": 0.867, "xylene": 0.860, "isopar": 0.760, "kerosene": 0.800, "mineral oil": 0.830, "ethanol": 0.789, "methanol": 0.792,
    "isopropanol": 0.786, "acetone": 0.791, "dmf": 0.944, "dmac": 0.937, "nmp": 1.028, "chloroform": 1.489, "dichloromethane": 1.326,
}
SOLUTE_DENSITY = {
    "triethylamine": 0.726, "piperidine": 0.862, "aniline": 1.022, "ethanol": 0.789, "methanol": 0.792, "isopropanol": 0.786, "glycerol": 1.261,
    "nmp": 1.028, "dmf": 0.944, "dmac": 0.937, "toluene": 0.867, "xylene": 0.860, "cyclohexane": 0.779, "hexane": 0.659, "n-hexane": 0.659,
    "heptane": 0.684, "octane": 0.703, "isooctane": 0.692, "acetone": 0.791, "chloroform": 1.489, "dichloromethane": 1.326,
}

# ---- fixed values: solvent aliases; the first canonical name with an alias in the text wins ----
SOLVENT_ALIASES = [
    ("water", ["water", "h2o", "deionized water", "distilled water", "di water", "去离子水", "水"]),
    ("n-hexane", ["n-hexane", "hexane", "正己烷", "己烷"]), ("cyclohexane", ["cyclohexane", "环己烷"]), ("heptane", ["heptane", "庚烷"]),
    ("octane", ["octane", "辛烷"]), ("isooctane", ["isooctane", "异辛烷"]), ("toluene", ["toluene", "甲苯"]), ("xylene", ["xylene", "二甲苯"]),
    ("isopar", ["isopar"]), ("kerosene", ["kerosene", "煤油"]), ("mineral oil", ["mineral oil", "矿物油"]), ("ethanol", ["ethanol", "alcohol", "乙醇"]),
    ("methanol", ["methanol", "甲醇"]), ("isopropanol", ["isopropanol", "ipa", "异丙醇"]), ("acetone", ["acetone", "丙酮"]),
    ("dmf", ["dmf", "n,n-dimethylformamide", "二甲基甲酰胺"]), ("dmac", ["dmac", "dimethylacetamide", "二甲基乙酰胺"]),
    ("nmp", ["nmp", "n-methyl-2-pyrrolidone", "甲基吡咯烷酮"]), ("chloroform", ["chloroform", "三氯甲烷"]),
    ("dichloromethane", ["dichloromethane", "methylene chloride", "二氯甲烷"]),
]

# ---- fixed values: solutes whose phase is known ----
AQUEOUS_SOLUTES = [
    "nacl", "sodium chloride", "mpd", "m-phenylenediamine", "pip", "piperazine", "sds", "sodium dodecyl sulfate", "edc", "nhs", "tea", "triethylamine",
    "naoh", "sodium hydroxide", "sodium carbonate", "csa", "camphorsulfonic acid", "cucl2", "ascorbic acid", "polyvinyl alcohol", "pva", "pvs",
]
ORGANIC_SOLUTES = ["tmc", "trimesoyl chloride", "btec", "mm-btec", "cyanuric chloride", "acyl chloride", "benzene-1,3,5-tricarbonyl chloride"]

# ---- fixed values: conversion statuses ----
SUCCESS = ["DIRECT_WT", "SAFE_CONVERTED", "ASSUMED_CONVERTED", "RULE_NORMALIZED_CONVERTED", "LLM_UNIT_REPAIRED_CONVERTED", "LLM_FORMULA_CONVERTED"]

# ---- fixed values: units. compact spelling -> canonical unit, by family ----
MASS_FRACTION = [
    "wt%", "wt.%", "weight%", "mass%", "wtpercent", "masspercent", "w/w%", "%w/w", "m/m%", "%m/m", "weightpercent", "%(w/w)", "%(m/m)", "%(wt)", "%(mass)",
    "wt", "w/w", "m/m", "massfraction", "weightfraction",
]
MASS_VOLUME = ["w/v%", "%w/v", "wt/v%", "%wt/v", "w/v", "wt/v", "wv", "wtv", "%(w/v)", "%(wt/v)", "%(m/v)", "m/v", "g/100milliliter", "g/100milliliters", "wt/vol%", "w/v.%"]
GRAMS_PER_100ML = ["g/100ml", "g/100l", "g/dl"]
MASS_CONCENTRATION = {
    "g/l": "g/L", "gl-1": "g/L", "g.l-1": "g/L", "mg/l": "mg/L", "mgl-1": "mg/L", "mg.l-1": "mg/L", "ug/l": "ug/L", "ugl-1": "ug/L", "ug.l-1": "ug/L",
    "ng/l": "ng/L", "ngl-1": "ng/L", "ng.l-1": "ng/L", "mg/ml": "mg/mL", "mgml-1": "mg/mL", "mg.ml-1": "mg/mL", "g/ml": "g/mL", "g.ml-1": "g/mL",
    "ug/ml": "ug/mL", "ugml-1": "ug/mL", "ug.ml-1": "ug/mL",
}
MOLARITY = {
    "mol/l": "mol/L", "moll-1": "mol/L", "mol.l-1": "mol/L", "mmol/l": "mmol/L", "mmoll-1": "mmol/L", "mmol.l-1": "mmol/L", "monomoles/l": "mol/L", "monomolesl-1": "mol/L",
}
VOLUME_FRACTION = {"v/v%": "v/v%", "%v/v": "v/v%", "v/v": "v/v%", "%(v/v)": "v/v%", "vol%": "vol%", "vol.%": "vol%", "vol": "vol%", "ml/l": "mL/L"}
PPM_FAMILY = {"ppm": "ppm", "ppb": "ppb", "g/kg": "g/kg", "mg/kg": "mg/kg"}
BARE_AMOUNTS = ["drops", "drop", "g", "ml", "mmol", "mol", "l", "ul"]

# ---- fixed values: identity guard ----
SIMILARITY_STOP = ["the", "of", "and", "for", "acid", "salt"]
MATERIAL_CONTEXT = (
    r"(?i)\b(graphene|oxide|poly|polymer|nanocomposite|composite|nanofiller|nanoparticle|membrane|membranes|cnt|carbon\s*nanotube|nanotube|go|rgo|"
    r"cellulose|chitosan|peg|peo|pva|pan|psf|pes|crosslink|graft|nanosheet)\b"
)
SMALL_MOLECULES = r"(?i)\b(methane|ethane|propane|butane|benzene|toluene|xylene|water|acetone|methanol|ethanol)\b"

# ---- fixed values: names in documents ----
MATERIAL_KEYWORDS = [
    "nanoparticle", "nanosheet", "nanosphere", "nanotube", "nanofiller", "membrane", "framework", "graphene oxide", "metal-organic framework", "metal organic framework",
    "mcm-41", "mesoporous", "silica", "mof", "go", "msn", "poly(", "polymer", "copolymer", "modified", "functionalized", "grafted", "composite", "resin", "material",
    "support", "sheet", "commercial", "series", "model", "substrate",
]
GENERIC_NAMES = ["membrane", "support", "substrate", "glass", "hydrophilicity", "roughness", "permeability", "anti-fouling", "antifouling"]
GENERIC_SINGLE_WORDS = [
    "glass", "gold", "membrane", "solvent", "solvents", "structure", "hydrophilicity", "accordi", "lower", "higher", "different", "organic", "role", "signal",
    "fluid", "mixture", "test",
]
CHEMICAL_ENDINGS = [
    "acid", "amine", "amide", "aniline", "imide", "chloride", "bromide", "iodide", "fluoride", "oxide", "hydroxide", "sulfonate", "sulfonic acid", "phosphonic acid",
    "phosphate", "imidazolium chloride", "alcohol", "ketone", "aldehyde", "ester", "ether", "piperazine", "succinimide", "nanotube", "nanotubes", "graphene oxide",
    "quantum dots", "mcm-41", "halloysite nanotubes", "polyamide", "polyethersulfone",
]
BAD_CANDIDATE_PHRASES = [
    "synthesized", "reaction", "normalized", "used", "prepared", "obtained", "calculated", "measured", "according to", "based on", "figure", "table", "compared with",
    "showed that", "demonstrated", "in this paper", "in this study", "radius of", "surface area", "contact angle", "flux", "rejection", "followed by", "detected in",
    "modified by", "coated with", "immersed in", "weight loss", "step between", "reported that", "attributed to", "immersion", "during the", "after the", "before the",
    "between the", "resulting in", "leading to", "consisting of", "composed of", "dissolved in", "mixed with", "added to", "placed in", "soaked in", "dipped in",
    "treated with", "blended with", "washing", "rinsing", "filtration", "centrifugation", "sonication", "annealing", "drying", "coating the", "casting the",
    "spinning the", "heating the",
]
# rules for candidates in lower case, one entry a rule
CANDIDATE_BAD_STARTS = [
    r"^(and|or|but|also|then|yet|nor|so|if)\b",
    r"^(followed|detected|reported|modified|coated|immersed|dissolved|mixed|added|placed|soaked|dipped|treated|blended|combined|consisting|composed|derived|resulting|"
    r"attributed|prepared|obtained|used|described|observed)\b",
    r"^(the|a|an|this|these|those|its|their)\s+\w+\s+(is|was|were|are|has|had|have)\b",
]
CANDIDATE_BAD_PARTS = [
    r"\b(into|onto|from|between|during|after|before|upon|through)\s+the\b",
    r"\b(was|were|is|are|has|had|have|been|being)\s+\w+ed\b",
    r"\b\d+(\.\d+)?\s*(%|wt|vol|mol|mg|g/l|ml|min|hour|h|ppm|bar|mpa)\b",
]
DOI = r"(?i)\b10\.\d{4,9}/[-._;()/:A-Z0-9]+"
UNRESOLVED = ["NO_HIT", "NO_SPECIFIC_CHEMICAL", "ABBR_EXPANDED_NO_HIT", "NOT_CHEMICAL_FROM_LLM", "CID_ONLY", "EMPTY_QUERY", "EMPTY_CANDIDATE"]

# ---- fixed values: what is cut from the start of a candidate name, one after another ----
CANDIDATE_STARTS = [
    r"(?i)^(the|a|an|this|these|those|its|their|our|some|such)\s+",
    r"(?i)^(followed by|modified by|detected in|used as|reported that|immersed in|coated with|based on|according to|prepared from|obtained from|dissolved in|mixed with|"
    r"added to|placed in|soaked in|dipped in|treated with|blended with|combined with|consisting of|composed of|derived from|resulting from|attributed to|referred to as|"
    r"known as|described as)\s+",
    r"(?i)^(and|or|but|also|then|yet|nor)\s+",
    r"(?i)^(in this paper|in this study|in this work|here|namely|such as|including|e\.g\.,?|i\.e\.,?|for example|for instance)\s*[,:]?\s*",
    r"(?i)\b(and|or|with|for|of|as|by|in|on|at|to)\s*$",
]
CANDIDATE_VERBS = r"(?i)^.*?\b(namely|is|was|were|denoted as|abbreviated as|stands for|means|refers to|defined as|called|named)\b\s*"
CANDIDATE_LEADS = r"(?i)^(followed by|modified by|detected in|coated with|immersed in|role of|which comprised of|as well as|illustrates the structure of)\s+"

# ---- fixed values: core names ----
CORE_PREFIXES = [
    r"(?:aqueous|dilute|concentrated|saturated|anhydrous|dry|pure|fresh|degassed|filtered)\s+",
    r"(?:commercial|standard|reagent[\s-]grade|analytical[\s-]grade|hplc[\s-]grade|acs[\s-]grade|technical[\s-]grade)\s+",
    r"(?:cross[\s-]?linked|modified|functionalized|grafted|activated|treated|coated|doped|supported)\s+",
]
CORE_SUFFIXES = (
    r"(?i)(?:\s*(?:solution|solutions|buffer|dispersion|suspension|emulsion|slurry|precursor|precursors|additive|additives|filler|fillers|membrane|membranes|substrate|"
    r"substrates|support|supports|composite|composites|material|materials|blend|blends|layer|layers|coating|coatings|film|films|thin[\s-]film|interlayer|interlayers|"
    r"surface|surfaces|matrix|nanocomposite|nanocomposites|reagent|reagents)\s*)+$"
)
CORE_QUANTITY = r"(?i)\s+\d+(?:\.\d+)?\s*(?:wt|vol|mol|w/w|v/v|w/v|%|g/L|mg/L|mg/mL|ppm|ppb|M|mM|μM|nM)\b.*"

# ---- fixed values: backtrace statuses by rank ----
BACKTRACE_RANK = {
    "BACKTRACE_HIT": 8, "BACKTRACE_OK": 7, "BACKTRACE_NAME_OK": 6, "BACKTRACE_CLASSIFIED": 5, "EXPANSION_FOUND_BUT_PUBCHEM_NO_HIT": 4,
    "LLM_EXPANSION_BUT_PUBCHEM_NO_HIT": 4, "CONTEXT_FOUND_BUT_NO_EXPANSION": 3, "TOKEN_NOT_IN_MD": 2, "MD_NOT_FOUND": 1, "RAW_ROW_NOT_FOUND": 0,
    "MISSING_SOURCE_RECORDINDEX": 0,
}

# ---- fixed values: physical form ----
LIQUIDS = [
    "triethylamine", "piperidine", "aniline", "ethanol", "methanol", "isopropanol", "glycerol", "nmp", "dmf", "dmac", "toluene", "xylene", "hexane", "n-hexane",
    "cyclohexane", "heptane", "octane", "isooctane", "acetone", "chloroform", "dichloromethane",
]
SOLIDS = [
    "sodium chloride", "nacl", "m-phenylenediamine", "mpd", "piperazine", "pip", "trimesoyl chloride", "tmc", "camphorsulfonic acid", "csa", "sodium hydroxide", "naoh",
    "sodium carbonate", "sodium dodecyl sulfate", "sds", "potassium persulfate", "edc", "nhs",
]
SOLID_HINTS = ["acrylamide", "bisacrylamide", "persulfate", "hydroxide", "carbonate", "sulfonate", "sulfate", "chloride", "salt"]
LIQUID_HINTS = [
    "ethanol", "methanol", "isopropanol", "glycerol", "triethylamine", "aniline", "toluene", "xylene", "hexane", "cyclohexane", "heptane", "octane", "isooctane",
    "acetone", "chloroform", "dichloromethane",
]

# ---- fixed values: spellings under which a name is sought in a document ----
ABBR_SEARCH = {
    "NH2": ["amino", "amine"], "COOH": ["carboxyl", "carboxylic"], "SO3H": ["sulfonic", "sulfonated"], "GO": ["graphene oxide"],
    "MOF": ["metal organic framework", "metal-organic framework"], "MSN": ["mesoporous silica nanoparticle", "mesoporous silica nanoparticles"],
    "HNT": ["halloysite nanotube", "halloysite nanotubes"], "MCM": ["mcm-41"],
}
TOKEN_ALIASES = {
    "AGO": ["aminated graphene oxide", "amine-functionalized graphene oxide"],
    "HNT-COOH": ["carboxylated HNT", "carboxylated halloysite nanotube", "COOH-HNT"],
    "NH2-MCM-41": ["amino-functionalized MCM-41", "amino MCM-41"],
    "MCM-41-NH2": ["amino-functionalized MCM-41", "amino MCM-41"],
}

# ---- fixed values: names that a document defines for an abbreviation ----
EXPANSION_BAD_PREFIXES = [
    "and ", "or ", "but ", "also ", "then ", "yet ", "followed by ", "used as ", "reported that ", "detected in ", "modified by ", "coated with ", "immersed in ",
    "role of ", "illustrates the structure of ", "as well as ", "which comprised of ", "somewhat ", "according to ", "based on ", "for test and ",
]
EXPANSION_BAD_PATTERNS = [
    r"\b(role of|illustrates the structure of|different organic solvents|somewhat lower|weight loss|step between)\b",
    r"^(and|or|but|also|then|which|where|when|while|that)\b",
    r"^(reported|detected|modified|coated|immersed|used|followed|illustrates|selected|supplied|comprised)\b",
    r"\b(usa|inc|ltd|corp|company|supplier|vendor|commercial)\b",
]
EXPANSION_LATE_PATTERNS = [
    r"\b(followed|detected|reported|selected|supplied|illustrates|comprised|according|based)\b",
    r"\b\d+(\.\d+)?\s*(%|wt|vol|mol|mg|g/l|ml|min|hour|h|ppm|bar|mpa)\b",
]

# ---- fixed values: queries that no registry should be asked; these come after BAD_CANDIDATE_PHRASES ----
BAD_QUERY_PHRASES = [
    "immersed", "solution", "dissolved", "stirred", "heated", "dried", "subsequently", "was added", "mixed with", "poured", "coated", "rinsed", "washed", "filtered",
    "centrifuged", "sonicated", "purchased from", "supplied by", "obtained from", "provided by", "bought from", "donated by", "received from", "inc.", "inc,", "ltd.",
    "ltd,", "co.", "co,", "corp.", "corp,", "company", "supplier", "manufacturer", "vendor", "distributor", "usa", "u.s.a", "u.s.a.", "china", "germany", "japan", "korea",
    "india", "france", "uk", "canada", "taiwan", "singapore", "osmonics", "hydranautics", "dow chemical", "toray", "ge water", "nitto denko", "koch membrane", "filmtec",
    "sepro", "sigma-aldrich", "sigma aldrich", "merck", "alfa aesar", "fisher scientific", "aladdin", "sinopharm", "acros", "aldrich", "fluka", "tci", "wt%", "vol%",
    "mol/l", "mg/l", "g/l", "mol%", "respectively", "therefore", "however", "moreover", "furthermore", "the result", "was found", "it was", "can be", "which was",
    "membrane was", "membrane is", "onto the", "into the", "in order to", "as shown", "as reported", "as described",
]
QUERY_BAD_PATTERNS = [
    r"^(and|or|but|also|then|so|yet|nor|for|as|if|which|that)\b",
    r"^(followed|detected|reported|modified|coated|immersed|dissolved|mixed|added|placed|soaked|dipped|treated|blended|combined|used|prepared|obtained|described|observed|"
    r"showed|found|noted|maintained|enhanced|optimized|deposited)\b",
    r"\b(role of|illustrates the structure of|different organic solvents|weight loss|step between|maintained at|deposited on|solution of|supported by|supplied by|"
    r"purchased from)\b",
]

# ---- fixed values: what is cut from a query, one step after another ----
QUERY_CUTS = [
    r"^\"+|\"+$",
    r"^(and|or|but|also|then|yet|nor)\s+",
    r"^(solution of|aqueous solution of|mixture of|blend of|blend containing|containing|including|comprised of|consisting of|composed of|derived from|reported as|"
    r"known as|described as)\s+",
    r"^(the|a|an|this|these|those)\s+",
    r"\b(modified|functionalized|used|prepared|based|supported|coated|grafted|loaded)\b.*$",
    r"\((?:[^()]*(?:sigma|aldrich|hydranautics|osmonics|usa|china|japan|germany|supplier|company|corp|inc|ltd)[^()]*)\)",
    r"\b(solvent|derivative|membrane|composite|material|monomer|polymer|product|grade)\b$",
    r"\b(solution|mixture|blend)\b$",
    r"\b(additive|modifier|filler|dopant|crosslinker|cross-linker|agent|reagent)\b$",
    r"\b\d+(?:\.\d+)?\s*(?:wt%|vol%|mol%|mg/l|g/l|mmol|mol/l|m|mm|cm|nm|μm|um|kda|ppm|bar|mpa|°c|c)\b",
    r"\b(purchased|obtained|supplied|provided|sourced|acquired)\s+(from|by)\b.*$",
    r"\b(with|of)\s+(?:high\s+)?purity\b.*$",
    r"\s*[≥≤><=]\s*\d+(?:\.\d+)?\s*%.*$",
    r"\b(anhydrous|reagent\s+grade|analytical\s+grade|technical\s+grade|hplc\s+grade|acs\s+grade|laboratory\s+grade)\b.*$",
    r"\b(stored|dried|distilled|purified|filtered|degassed)\s+(over|from|under|with)\b.*$",
    r"\$[^$]*\$",
    r"\s*#.*$",
    r"\(\s*\d+(?:\.\d+)?\s*%?\s*\)",
    r"\s*[,;:]\s*$",
]
QUERY_CLAUSES = ["which", "that", "where", "while", "after", "before", "during"]

# ---- fixed values: classes of names without a compound of their own, and signs of one ----
MATERIAL_CLASSES = ["nanoparticle", "nanotube", "framework", "mcm-41", "mof", "graphene oxide", "quantum dots", "membrane", "composite", "polymer", "copolymer"]
NOT_WORTH_ASKING = [
    r"poly(?:mer|imide|amide|sulfone|ether|ethersulfone|vinylidene|acrylonitrile|carbonate|urethane|propylene|ethylene|styrene)",
    r"copolymer|terpolymer|blend|nanocomposite|composite",
    r"metal[\s-]organic\s+framework|mof|zif[\s-]\d+",
    r"graphene\s+oxide|reduced\s+graphene|go\b",
    r"carbon\s+nanotube|cnt|mwcnt|swcnt",
    r"mesoporous\s+silica|mcm[\s-]41|sba[\s-]15|msp",
    r"halloysite|nanotube|nanosheet|nanofiber|nanofiller|nanoparticle|nano",
    r"membrane\b|substrate\b|support\b|matrix\b|framework\b",
    r"commercial\s+\w+|filmtec|espa|bw30|sw30|xle|tfc|ro\s+membrane|nf\s+membrane",
    r"series\b|model\b|grade\b|product\b",
]
WORTH_ASKING = [
    r"acid|amine|amide|aniline|imide|chloride|bromide|iodide|fluoride",
    r"oxide(?!\s+membrane)|hydroxide|sulfonate|sulfate|phosphate|carbonate|nitrate|acetate",
    r"piperazine|succinimide|pyrrolidone|pyrrolidine|imidazol",
    r"alcohol|ketone|aldehyde|ester|ether(?!\s+sulfone)",
    r"benzene|toluene|xylene|phenol|aniline|naphthalene|anthracene",
    r"methane|ethane|propane|butane|pentane|hexane",
    r"methanol|ethanol|propanol|butanol|glycol",
    r"acetone|acetonitrile|dimethyl|diethyl",
    r"sodium|potassium|lithium|magnesium|calcium|ammonium",
    r"trimesoyl|phenylenediamine|terephthaloyl|isophthaloyl",
]

# ---- fixed values: patterns around a token, with the text that names it; score and rule ----
NAME_TEXT = r"([A-Za-z][A-Za-z0-9,\-/()'\s]{3,120})"
CONTEXT_RULES = [
    (NAME_TEXT + r"\s*[\(（]\s*{token}\s*[\)）]", 0.97, "full(abbr)"),
    (r"{token}\s*[\(（]\s*" + NAME_TEXT + r"\s*[\)）]", 0.95, "abbr(full)"),
    (r"{token}\s*(?:=|:|stands for|means|refers to|denotes|is|was|were)\s*" + NAME_TEXT, 0.90, "definition"),
    (NAME_TEXT + r"\s*,\s*(?:abbreviated as|denoted as|hereafter|herein|referred to as)\s+{token}", 0.84, "apposition"),
    (r"{token}\s*,?\s*(?:known as|also called|also known as|named|i\.e\.,?)\s+" + NAME_TEXT, 0.82, "known_as"),
    (NAME_TEXT + r"\s*[\(（][^)）]{0,20}{token}[^)）]{0,20}[\)）]", 0.78, "full(..abbr..)"),
]
CLASS_HINTS = (
    r"(commercial|additive|modifier|polymer|copolymer|membrane|framework|nanoparticle|series|resin|material|nanosheet|mesoporous|functionalized|modified)"
)

# ---- fixed values: a concentration in running text; its value, then its unit, the first that fits ----
TEXT_NUMBER = r"([-+]?\d*\.?\d+(?:[eE][-+]?\d+)?)\s*"
TEXT_UNITS = [
    r"%\s*\((?:w/v|m/v|w/w|v/v|wt)\)",
    r"wt\s*/?\s*v%?", r"w\s*/?\s*v%?", r"v\s*/?\s*v%?",
    r"vol\.?\s*%?", r"wt%", r"w/w%", r"m/m%", r"mass%",
    r"g\s*/\s*100\s*mL", r"g\s*/\s*L", r"mg\s*/\s*L", r"ug\s*/\s*L", r"ng\s*/\s*L",
    r"mg\s*/\s*mL", r"ug\s*/\s*mL",
    r"mmol\s*/\s*L", r"mol\s*/\s*L",
    r"mM\b",
    r"(?<![A-Za-z0-9])M(?![A-Za-z])",
    r"mL\s*/\s*L",
    r"ppm", r"ppb", r"g\s*/\s*kg", r"mg\s*/\s*kg",
    r"%",
]
#: words beside a concentration that speak of a purchase or a purity
PURCHASE_WORDS = ["sigma", "aldrich", "purity", "purchased", "supplied by", ">", "≥"]
TYPED_UNITS = ["w/v", "m/v", "v/v", "w/w", "wt"]

# ---- fixed values: words in the names of columns ----
SAMPLE_COLUMNS = ["样品", "sample", "filename", "file", "title", "题目", "文献标题"]
TITLE_COLUMNS = ["title", "题目", "文献标题", "paper title"]
FILE_COLUMNS = ["file", "filename", "文件名"]
DENSITY_COLUMNS = ["density", "密度"]
DENSITY_WORDS = {
    "aqueous_monomer": ["aqueous", "water", "水相"],
    "organic_monomer": ["organic", "oil", "油相"],
    "additive": ["solution", "solvent", "溶液", "density", "密度"],
    "modifier": ["solution", "solvent", "溶液", "density", "密度"],
    "test_nacl": ["test", "nacl", "solution", "水相", "aqueous"],
}
SOLVENT_COLUMNS = ["solvent", "溶剂"]
WATER_COLUMNS = ["aqueous", "water", "水相"]
OIL_COLUMNS = ["organic", "oil", "油相"]
