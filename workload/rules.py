"""The rule tables that the SQL twins use, written out from the blueprint and not taken from the library."""

# Substrings of a place, by category; the first category with a match wins.
PLACE_WORDS = {
    "Residential": "RESIDENCE, APARTMENT, HOUSE, ROOMING HOUSE, COACH HOUSE, PORCH, HALLWAY, GARAGE, YARD, BASEMENT",
    "Transportation": "CTA, TRAIN, BUS, RAILROAD, HIGHWAY, EXPRESSWAY, AIRPORT, AIRCRAFT, VEHICLE, TRUCK, TAXI, LIVERY, "
    "PARKING LOT, PARKING LOT/GARAGE",
    "Food & Entertainment": "BAR, TAVERN, LIQUOR STORE, RESTAURANT, MOVIE HOUSE, THEATER, CASINO, CLUB, SPORTS ARENA, STADIUM, "
    "YMCA, BOWLING ALLEY, POOL ROOM, POOLROOM, BANQUET HALL",
    "Commercial": "STORE, SHOP, DEALERSHIP, BANK, CREDIT UNION, CURRENCY EXCHANGE, PAWN, OFFICE, NEWSSTAND, CLEANERS, LAUNDROMAT, "
    "BARBER, BEAUTY SALON, CAR WASH, COIN OPERATED MACHINE",
    "Institutional": "SCHOOL, COLLEGE, UNIVERSITY, HOSPITAL, NURSING, RETIREMENT HOME, GOVERNMENT, POLICE, JAIL, PRISON, CHURCH, "
    "SYNAGOGUE, PLACE OF WORSHIP, LIBRARY, FIRE STATION, PUBLIC HIGH SCHOOL, PUBLIC GRAMMAR SCHOOL",
    "Industrial": "FACTORY, WAREHOUSE, CONSTRUCTION, JUNK YARD, GARBAGE DUMP, TRUCKING TERMINAL, FARM, INDUSTRIAL, LOADING DOCK",
    "Public Outdoor": "STREET, SIDEWALK, ALLEY, PARK, PARK PROPERTY, BEACH, LAKEFRONT, LAKE, RIVERBANK, RIVER BANK, RIVER, "
    "FOREST PRESERVE, PRAIRIE, VACANT LOT, VACANT LOT/LAND, VACANT LOT / LAND, WOODED AREA, BRIDGE, GANGWAY, PLAY LOT, "
    "CHA GROUNDS, YARD, EXPRESSWAY EMBANKMENT",
}
PUBLIC_PLACES = ["Public Outdoor", "Transportation", "Food & Entertainment"]

# Primary types by category, and by severity.
CRIME_TYPES = {
    "Violent Crime": "HOMICIDE, CRIM SEXUAL ASSAULT, CRIMINAL SEXUAL ASSAULT, SEX OFFENSE, BATTERY, ASSAULT, ROBBERY, KIDNAPPING, "
    "OFFENSE INVOLVING CHILDREN, HUMAN TRAFFICKING, DOMESTIC VIOLENCE, INTIMIDATION, STALKING",
    "Property Crime": "BURGLARY, THEFT, MOTOR VEHICLE THEFT, ARSON, CRIMINAL DAMAGE, CRIMINAL TRESPASS, DECEPTIVE PRACTICE, "
    "OTHER OFFENSE, OBSCENITY",
    "Drug/Weapon Crime": "NARCOTICS, OTHER NARCOTIC VIOLATION, WEAPONS VIOLATION, CONCEALED CARRY LICENSE VIOLATION",
    "Public Order Crime": "PUBLIC PEACE VIOLATION, INTERFERENCE WITH PUBLIC OFFICER, LIQUOR LAW VIOLATION, GAMBLING, "
    "PUBLIC INDECENCY, RITUALISM, NON-CRIMINAL",
}
HIGH_SEVERITY = (
    "HOMICIDE, CRIM SEXUAL ASSAULT, CRIMINAL SEXUAL ASSAULT, SEX OFFENSE, KIDNAPPING, HUMAN TRAFFICKING, ARSON, "
    "OFFENSE INVOLVING CHILDREN"
)
# Violent types, drug and weapon types, and these.
MEDIUM_SEVERITY = (
    "BURGLARY, ROBBERY, MOTOR VEHICLE THEFT, CRIMINAL DAMAGE, CRIMINAL TRESPASS, DECEPTIVE PRACTICE, PROSTITUTION"
)
TOP_LOCATIONS = 20


def words(text: str) -> list[str]:
    return text.split(", ")
