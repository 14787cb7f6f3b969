"""Places: city, state and country out of free text, and who is not in Germany."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SENTINELS, strip

# States by English name with code and German name.
STATES = {
    "Baden-Württemberg": ("BW", "Baden-Württemberg"), "Bavaria": ("BY", "Bayern"), "Berlin": ("BE", "Berlin"), "Brandenburg": ("BB", "Brandenburg"), "Bremen": ("HB", "Bremen"), "Hamburg": ("HH", "Hamburg"),
    "Hesse": ("HE", "Hessen"), "Lower Saxony": ("NI", "Niedersachsen"), "Mecklenburg-West Pomerania": ("MV", "Mecklenburg-Vorpommern"), "North Rhine-Westphalia": ("NW", "Nordrhein-Westfalen"),
    "Rhineland-Palatinate": ("RP", "Rheinland-Pfalz"), "Saarland": ("SL", "Saarland"), "Saxony": ("SN", "Sachsen"), "Saxony-Anhalt": ("ST", "Sachsen-Anhalt"), "Schleswig-Holstein": ("SH", "Schleswig-Holstein"), "Thuringia": ("TH", "Thüringen"),
}
CITY_STATES = ("Berlin", "Hamburg", "Bremen")
# Regions in the order in which the first partial match wins: state, city, country. "NA" is a literal.
REGIONS: list[tuple[str, str | None, str | None, str]] = [
    ("Stuttgart Region", "Baden-Württemberg", "Stuttgart", "Germany"),
    ("Greater Munich Metropolitan Area", "Bavaria", "Munich", "Germany"),
    ("Munich Metropolitan Area", "Bavaria", "Munich", "Germany"),
    ("Berlin Metropolitan Area", "Berlin", "Berlin", "Germany"),
    ("Greater Berlin Area", "Berlin", "Berlin", "Germany"),
    ("Ruhr Region", "North Rhine-Westphalia", None, "Germany"),
    ("Ruhr Area", "North Rhine-Westphalia", None, "Germany"),
    ("Frankfurt Rhine-Main Metropolitan Area", "Hesse", "Frankfurt", "Germany"),
    ("Rhine-Main Area", "Hesse", "Frankfurt", "Germany"),
    ("Hannover-Braunschweig-Göttingen-Wolfsburg Region", "Lower Saxony", None, "Germany"),
    ("Cologne Bonn Region", "North Rhine-Westphalia", None, "Germany"),
    ("Greater Hamburg Area", "Hamburg", "Hamburg", "Germany"),
    ("Greater Nuremberg Metropolitan Area", "Bavaria", "Nuremberg", "Germany"),
    ("Greater Leipzig Area", "Saxony", "Leipzig", "Germany"),
    ("Greater Dusseldorf Area", "North Rhine-Westphalia", "Düsseldorf", "Germany"),
    ("Greater Dresden Area", "Saxony", "Dresden", "Germany"),
    ("Greater Karlsruhe Area", "Baden-Württemberg", "Karlsruhe", "Germany"),
    ("Greater Aschaffenburg Area", "Bavaria", "Aschaffenburg", "Germany"),
    ("Greater Bremen Area", "Bremen", "Bremen", "Germany"),
    ("Greater Kiel Area", "Schleswig-Holstein", "Kiel", "Germany"),
    ("Greater Erfurt Area", "Thuringia", "Erfurt", "Germany"),
    ("Greater Magdeburg Area", "Saxony-Anhalt", "Magdeburg", "Germany"),
    ("Greater Bielefeld Area", "North Rhine-Westphalia", "Bielefeld", "Germany"),
    ("Greater Oldenburg Area", "Lower Saxony", "Oldenburg", "Germany"),
    ("Greater Freiburg Area", "Baden-Württemberg", "Freiburg", "Germany"),
    ("Greater Heilbronn Region", "Baden-Württemberg", "Heilbronn", "Germany"),
    ("Greater Kempten Area", "Bavaria", "Kempten", "Germany"),
    ("Greater Rostock Region", "Mecklenburg-West Pomerania", "Rostock", "Germany"),
    ("Rhein-Neckar Metropolitan Region", "Baden-Württemberg", None, "Germany"),
    ("Rhine-Neckar Metropolitan Region", "Baden-Württemberg", None, "Germany"),
    ("Osnabrück Land", "Lower Saxony", "Osnabrück", "Germany"),
    ("Zürich Metropolitan Area", "NA", "Zürich", "Switzerland"),
    ("Greater Zürich Area", "NA", "Zürich", "Switzerland"),
    ("Sankt Gallen Metropolitan Area", "NA", "St. Gallen", "Switzerland"),
    ("Prague Metropolitan Area", "NA", "Prague", "Czech Republic"),
    ("Greater Prague Area", "NA", "Prague", "Czech Republic"),
    ("Johannesburg Metropolitan Area", "NA", "Johannesburg", "South Africa"),
    ("Greater Philadelphia", "Pennsylvania", "Philadelphia", "United States"),
    ("Greater Philadelphia Area", "Pennsylvania", "Philadelphia", "United States"),
]
# Names of regions beyond a country, of countries and US states, words of places abroad and in Germany, city names.
SUPER_REGIONS = ("DACH", "European Union", "European Economic Area", "Benelux", "Brabantine City Row")
COUNTRIES = ("Germany", "Netherlands", "France", "Austria", "Switzerland", "Poland", "Belgium", "Luxembourg", "Czech Republic", "Czech", "United States", "South Africa", "Liechtenstein", "India", "Singapore", "Spain", "Portugal", "Romania", "Ukraine", "Canada", "Australia", "United Kingdom", "Sweden", "Denmark", "Norway", "Finland", "Italy", "Hungary", "Slovakia")
GERMANY = ("germany", "de", "deutschland")
US_STATES = ("AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC", "PR")
FOREIGN = ("united states", "usa", "us", "uk", "united kingdom", "france", "spain", "italy", "netherlands", "belgium", "austria", "switzerland", "czechia", "czech republic", "poland", "sweden", "norway", "denmark", "finland", "portugal", "ireland", "canada", "australia", "india", "china", "japan", "brazil", "singapore")
FOREIGN_SUPER = ("emea", "apac", "worldwide", "global")
GERMAN_SIGNS = ("germany", "german", "deutschland", "münchen", "berlin", "hamburg", "frankfurt", "cologne", "stuttgart", "rhein", "rhein-main", "dach")
CITY_ALIASES = {"Munich": "München", "Cologne": "Köln", "Nuremberg": "Nürnberg", "Hanover": "Hannover", "Brunswick": "Braunschweig", "Aix-la-Chapelle": "Aachen", "Garching bei München": "Garching b. München"}


def literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def resolve_state(c: Column) -> Column:
    """English state name from a code, a German or an English name; other text as it is."""
    known = {code.lower(): en for en, (code, _) in STATES.items()} | {de.lower(): en for en, (_, de) in STATES.items()} | {en.lower(): en for en in STATES}
    return F.coalesce(F.element_at(literal_map(known), F.lower(strip(c))), strip(c))


def _place(city, state, country, strategy: str) -> Column:
    cast = lambda x: (x if isinstance(x, Column) else F.lit(x)).cast("string")
    return F.struct(cast(city).alias("city"), cast(state).alias("state"), cast(country).alias("country"), F.lit(strategy).alias("strategy"))


def parse_location(c: Column) -> Column:
    """STRUCT<city, state, country, strategy> by the number of comma-separated parts."""
    text = strip(c)
    low = F.lower(text)
    parts = F.transform(F.split(text, ","), strip)
    n = F.size(parts)
    first, second = F.element_at(parts, 1), F.get(parts, F.lit(1))
    tail = F.array_join(F.slice(parts, 3, F.greatest(n - 2, F.lit(0))), ", ")
    countries = literal_map({x.lower(): x for x in COUNTRIES})
    states = literal_map({x.lower(): x for x in STATES})
    country = lambda x: F.element_at(countries, F.lower(x))

    multi = (
        F.when(F.lower(tail).isin(*GERMANY), _place(first, resolve_state(second), "Germany", "standard_3part"))
        .otherwise(_place(first, second, F.coalesce(country(tail), tail), "coded_3part"))
    )
    two = (
        F.when(F.lower(second).isin(*GERMANY) & F.lower(first).isin(*[x.lower() for x in CITY_STATES]), _place(F.element_at(states, F.lower(first)), F.element_at(states, F.lower(first)), "Germany", "2part_city_state"))
        .when(F.lower(second).isin(*GERMANY) & F.element_at(states, F.lower(resolve_state(first))).isNotNull(), _place(None, resolve_state(first), "Germany", "2part_state_only"))
        .when(F.lower(second).isin(*GERMANY), _place(first, None, "Germany", "2part_city"))
        .when(country(second).isNotNull(), _place(first, None, country(second), "2part_foreign"))
        .otherwise(_place(first, second, None, "2part_foreign"))
    )
    regions = F.array(*[F.struct(F.lit(name.lower()).alias("name"), F.lit(state).cast("string").alias("state"), F.lit(city).cast("string").alias("city"), F.lit(country_).alias("country")) for name, state, city, country_ in REGIONS])
    exact = F.get(F.filter(regions, lambda r: r["name"] == low), F.lit(0))
    partial = F.get(F.filter(regions, lambda r: low.contains(r["name"]) | r["name"].contains(low)), F.lit(0))
    region = F.coalesce(exact, partial)
    one = (
        F.when(country(text).isNotNull(), _place(None, None, country(text), "bare_country"))
        .when(F.element_at(states, low).isNotNull(), _place(None, F.element_at(states, low), "Germany", "bare_state"))
        .when(region.isNotNull(), _place(region["city"], region["state"], region["country"], "region"))
        .otherwise(_place(None, None, None, "fallback"))
    )
    return (
        F.when(c.isNull() | low.isin(*{s.lower() for s in SENTINELS}), _place(None, None, None, "fallback"))
        .when(low.isin(*[s.lower() for s in SUPER_REGIONS]), _place(None, None, text, "super_region"))
        .when(n >= 3, multi).when(n == 2, two).otherwise(one)
    )


def is_non_german(raw: Column, state: Column, country: Column, *, substring_keywords: bool = True) -> Column:
    """True for places surely outside Germany.

    `substring_keywords` finds country words anywhere ("us" in "Cottbus" too), as the documented rule does; False asks for whole words.
    """
    low = F.lower(F.coalesce(raw, F.lit("")))
    has = (lambda ws: low.rlike("|".join(ws))) if substring_keywords else (lambda ws: low.rlike(r"(?U)\b(?:" + "|".join(ws) + r")\b"))
    return (
        F.coalesce(F.upper(state).isin(*US_STATES), F.lit(False))
        | has(FOREIGN)
        | F.coalesce(country != "Germany", F.lit(False))
        | has(FOREIGN_SUPER)
        | (country.isNull() & low.contains("area") & ~low.rlike("|".join(GERMAN_SIGNS)))
    )


def is_likely_non_german(raw: Column) -> Column:
    """A quick test on raw text alone."""
    return F.coalesce(raw, F.lit("")).rlike(r"(?iU)\b(?:" + "|".join((*FOREIGN, *FOREIGN_SUPER)) + r")\b")


def normalize_city(city: Column, state: Column) -> Column:
    """German names for aliases; Frankfurt is (Oder) in Brandenburg and am Main elsewhere."""
    aliased = F.coalesce(F.element_at(literal_map(CITY_ALIASES), city), city)
    return F.when(aliased == "Frankfurt", F.when(state.eqNullSafe("Brandenburg"), "Frankfurt (Oder)").otherwise("Frankfurt am Main")).otherwise(aliased)
