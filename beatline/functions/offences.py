"""Place and offence classification, and the risk score built on it."""

from pyspark.sql import Column, functions as F

from beatline.functions.casts import clamp

# Words that place a location in a category.  Categories are tried in this order and
# the first with a word anywhere in the text wins, so WAREHOUSE is Residential (HOUSE).
PLACE_WORDS = {
    "Residential": [
        "RESIDENCE", "APARTMENT", "HOUSE", "ROOMING HOUSE", "COACH HOUSE", "PORCH", "HALLWAY", "GARAGE",
        "YARD", "BASEMENT",
    ],
    "Transportation": [
        "CTA", "TRAIN", "BUS", "RAILROAD", "HIGHWAY", "EXPRESSWAY", "AIRPORT", "AIRCRAFT", "VEHICLE",
        "TRUCK", "TAXI", "LIVERY", "PARKING LOT", "PARKING LOT/GARAGE",
    ],
    "Food & Entertainment": [
        "BAR", "TAVERN", "LIQUOR STORE", "RESTAURANT", "MOVIE HOUSE", "THEATER", "CASINO", "CLUB",
        "SPORTS ARENA", "STADIUM", "YMCA", "BOWLING ALLEY", "POOL ROOM", "POOLROOM", "BANQUET HALL",
    ],
    "Commercial": [
        "STORE", "SHOP", "DEALERSHIP", "BANK", "CREDIT UNION", "CURRENCY EXCHANGE", "PAWN", "OFFICE",
        "NEWSSTAND", "CLEANERS", "LAUNDROMAT", "BARBER", "BEAUTY SALON", "CAR WASH",
        "COIN OPERATED MACHINE",
    ],
    "Institutional": [
        "SCHOOL", "COLLEGE", "UNIVERSITY", "HOSPITAL", "NURSING", "RETIREMENT HOME", "GOVERNMENT",
        "POLICE", "JAIL", "PRISON", "CHURCH", "SYNAGOGUE", "PLACE OF WORSHIP", "LIBRARY", "FIRE STATION",
        "PUBLIC HIGH SCHOOL", "PUBLIC GRAMMAR SCHOOL",
    ],
    "Industrial": [
        "FACTORY", "WAREHOUSE", "CONSTRUCTION", "JUNK YARD", "GARBAGE DUMP", "TRUCKING TERMINAL", "FARM",
        "INDUSTRIAL", "LOADING DOCK",
    ],
    "Public Outdoor": [
        "STREET", "SIDEWALK", "ALLEY", "PARK", "PARK PROPERTY", "BEACH", "LAKEFRONT", "LAKE", "RIVERBANK",
        "RIVER BANK", "RIVER", "FOREST PRESERVE", "PRAIRIE", "VACANT LOT", "VACANT LOT/LAND",
        "VACANT LOT / LAND", "WOODED AREA", "BRIDGE", "GANGWAY", "PLAY LOT", "CHA GROUNDS", "YARD",
        "EXPRESSWAY EMBANKMENT",
    ],
}
PLACE_DEFAULT = "Other"

# Risk weight of a place category; all others weigh 1.
PLACE_WEIGHTS = {
    3: ["Public Outdoor", "Transportation", "Food & Entertainment"],
    2: ["Residential", "Commercial", "Institutional", "Industrial"],
}
PUBLIC_PLACES = ["Public Outdoor", "Transportation", "Food & Entertainment"]

# Offences of each crime category.
CRIME_TYPES = {
    "Violent Crime": [
        "HOMICIDE", "CRIM SEXUAL ASSAULT", "CRIMINAL SEXUAL ASSAULT", "SEX OFFENSE", "BATTERY", "ASSAULT",
        "ROBBERY", "KIDNAPPING", "OFFENSE INVOLVING CHILDREN", "HUMAN TRAFFICKING", "DOMESTIC VIOLENCE",
        "INTIMIDATION", "STALKING",
    ],
    "Property Crime": [
        "BURGLARY", "THEFT", "MOTOR VEHICLE THEFT", "ARSON", "CRIMINAL DAMAGE", "CRIMINAL TRESPASS",
        "DECEPTIVE PRACTICE", "OTHER OFFENSE", "OBSCENITY",
    ],
    "Drug/Weapon Crime": [
        "NARCOTICS", "OTHER NARCOTIC VIOLATION", "WEAPONS VIOLATION", "CONCEALED CARRY LICENSE VIOLATION",
    ],
    "Public Order Crime": [
        "PUBLIC PEACE VIOLATION", "INTERFERENCE WITH PUBLIC OFFICER", "LIQUOR LAW VIOLATION", "GAMBLING",
        "PUBLIC INDECENCY", "RITUALISM", "NON-CRIMINAL",
    ],
}
CRIME_DEFAULT = "Other Crime"

# Offences of the two upper severities; a type in both is high.
HIGH_SEVERITY = [
    "HOMICIDE", "CRIM SEXUAL ASSAULT", "CRIMINAL SEXUAL ASSAULT", "SEX OFFENSE", "KIDNAPPING",
    "HUMAN TRAFFICKING", "ARSON", "OFFENSE INVOLVING CHILDREN",
]
MEDIUM_SEVERITY = [
    *CRIME_TYPES["Violent Crime"],
    *CRIME_TYPES["Drug/Weapon Crime"],
    "BURGLARY", "ROBBERY", "MOTOR VEHICLE THEFT", "CRIMINAL DAMAGE", "CRIMINAL TRESPASS",
    "DECEPTIVE PRACTICE", "PROSTITUTION",
]

# The risk score's flag weights and the raw range that is spread over 1..10.
NIGHT_WEIGHT = 2.0
DOMESTIC_WEIGHT = 1.5
PUBLIC_WEIGHT = 1.0
RAW_MIN, RAW_MAX = 2.0, 17.5


def _any_word(words: list[str]) -> str:
    """Pattern for texts with one of the words; a word that holds another one adds nothing."""
    return "|".join(w for w in words if not any(o in w for o in words if o != w))


def place_category(text: Column) -> Column:
    """Category of a location text; NULL and empty text are ``Other``.

    Searching for each word by itself is faster on this column alone, but ninety searches make the generated
    method of a whole projection too long for the JVM to compile, which is several times slower.
    """
    upper = F.upper(text)
    chain = F
    for category, words in PLACE_WORDS.items():
        chain = chain.when(upper.rlike(_any_word(words)), category)
    return chain.otherwise(PLACE_DEFAULT)


def place_weight(category: Column) -> Column:
    chain = F
    for weight, categories in PLACE_WEIGHTS.items():
        chain = chain.when(category.isin(categories), float(weight))
    return chain.otherwise(1.0)


def is_public_place(category: Column) -> Column:
    return category.isin(PUBLIC_PLACES)


def crime_category(primary_type: Column) -> Column:
    upper = F.upper(primary_type)
    chain = F
    for category, types in CRIME_TYPES.items():
        chain = chain.when(upper.isin(types), category)
    return chain.otherwise(CRIME_DEFAULT)


def _by_severity(primary_type: Column, high, medium, low) -> Column:
    upper = F.upper(primary_type)
    return F.when(upper.isin(HIGH_SEVERITY), high).when(upper.isin(MEDIUM_SEVERITY), medium).otherwise(low)


def severity_level(primary_type: Column) -> Column:
    return _by_severity(primary_type, "Level 3", "Level 2", "Level 1")


def severity_weight(primary_type: Column) -> Column:
    return _by_severity(primary_type, 10.0, 3.0, 1.0)


def raw_risk(severity: Column, place: Column, night: Column, domestic: Column, public: Column) -> Column:
    """Sum of the weights; a flag that is NULL adds nothing."""
    total = severity + place
    for flag, weight in ((night, NIGHT_WEIGHT), (domestic, DOMESTIC_WEIGHT), (public, PUBLIC_WEIGHT)):
        total = total + F.when(flag, weight).otherwise(0.0)
    return total


def risk_score(raw: Column) -> Column:
    """Raw risk spread linearly over 1..10 and held there."""
    return clamp(1.0 + (raw - RAW_MIN) * (9.0 / (RAW_MAX - RAW_MIN)), 1.0, 10.0)
