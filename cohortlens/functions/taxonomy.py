"""Titles to roles and places to countries, as expressions compiled from configuration."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import normalize_title


@dataclass(frozen=True)
class Role:
    slug: str
    match: tuple[str, ...]
    exclude: tuple[str, ...] = ()


@dataclass(frozen=True)
class Country:
    code: str
    region: str
    aliases: tuple[str, ...]
    codes: tuple[str, ...] = ()
    state_codes: tuple[str, ...] = ()
    market: str | None = None
    currency: str | None = None
    queried: bool = False


# Roles in order, with the fragments of a normalized title that name or exclude them.
ROLES = (
    Role("analytics-engineer", ("analytics engineer", "analytics developer", " bi engineer", "dbt engineer")),
    Role("mlops-engineer", ("mlops", " ml ops", " ml platform engineer", " ml infrastructure", "model ops", "llmops")),
    Role("ai-engineer", (" ai engineer", "genai engineer", "generative ai engineer", " llm engineer", " ai software engineer", "applied ai", "prompt engineer", " ai developer")),
    Role("ml-engineer", ("machine learning engineer", " ml engineer", "deep learning engineer", "computer vision engineer", " nlp engineer", "machine learning scientist"), ("manager", "director")),
    Role("data-engineer", ("data engineer", "data platform engineer", "data infrastructure engineer", "big data engineer", " etl developer", " etl engineer", "data warehouse engineer", "data pipeline engineer", "streaming engineer"), ("data entry", "manager", "director")),
    Role("data-scientist", ("data scientist", "research scientist machine learning", "decision scientist", "applied scientist", "quantitative researcher"), ("manager", "director")),
    Role("data-analyst", ("data analyst", "business intelligence analyst", " bi analyst", "reporting analyst", "insights analyst", "product analyst"), ("data entry",)),
)
GLOBAL_EXCLUDE = ("head of", "vp of", "vice president", " chief ", "recruiter", "sales engineer", "account executive", "internship coordinator")
RELEVANT = (" data ", " ml ", " ai ", " llm", " nlp ", "machine learning", "deep learning", "mlops", "computer vision", "genai", "analytics", "scientist", "business intelligence")

# Countries in order, with the names, codes and state codes that place a location there.
COUNTRIES = (
    Country(
        "US",
        "us",
        (
            "united states", "united states of america", "indiana", "indianapolis", "delaware", "new york", "new york city",
            "san francisco", "south san francisco", "bay area", "seattle", "austin", "boston", "chicago", "los angeles", "denver",
            "atlanta", "washington dc", "miami", "dallas", "houston", "san jose", "palo alto", "mountain view", "menlo park",
            "sunnyvale", "redwood city", "san mateo", "pittsburgh", "philadelphia", "salt lake city", "raleigh", "minneapolis",
            "phoenix", "san diego", "detroit", "nashville", "california", "texas", "massachusetts", "illinois", "colorado",
            "florida", "virginia", "north carolina", "oregon", "pennsylvania", "utah", "arizona", "michigan", "minnesota", "ohio",
            "new jersey", "maryland", "tennessee", "washington", "alabama", "alaska", "arkansas", "connecticut", "hawaii", "idaho",
            "iowa", "kansas", "kentucky", "louisiana", "maine", "mississippi", "missouri", "montana", "nebraska", "nevada",
            "new hampshire", "new mexico", "north dakota", "oklahoma", "rhode island", "south carolina", "south dakota", "vermont",
            "wisconsin", "wyoming",
        ),
        ("US", "USA", "NYC", "SF"),
        tuple("AL AK AZ AR CA CO CT DC FL GA HI ID IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY".split()),
        "us",
        "USD",
    ),
    Country("GB", "uk", ("united kingdom", "great britain", "britain", "england", "scotland", "wales", "northern ireland", "london", "manchester", "edinburgh", "glasgow", "bristol", "leeds", "belfast", "oxford", "cardiff", "brighton", "sheffield", "nottingham", "liverpool"), ("UK", "GB"), (), "gb", "GBP"),
    Country("DE", "eu", ("germany", "deutschland", "berlin", "munich", "münchen", "hamburg", "frankfurt", "cologne", "köln", "stuttgart", "düsseldorf", "dusseldorf", "leipzig"), (), (), "de", "EUR"),
    Country("FR", "eu", ("france", "paris", "lyon", "toulouse", "marseille", "bordeaux", "lille", "nantes"), (), (), "fr", "EUR"),
    Country("NL", "eu", ("netherlands", "the netherlands", "holland", "amsterdam", "rotterdam", "utrecht", "eindhoven", "the hague", "den haag"), (), (), "nl", "EUR"),
    Country("ES", "eu", ("spain", "españa", "madrid", "barcelona", "valencia", "seville", "sevilla", "malaga", "málaga"), (), (), "es", "EUR"),
    Country("IT", "eu", ("italy", "italia", "milan", "milano", "rome", "roma", "turin", "torino", "bologna"), (), (), "it", "EUR"),
    Country("PL", "eu", ("poland", "polska", "warsaw", "warszawa", "krakow", "kraków", "wroclaw", "wrocław", "gdansk", "gdańsk", "poznan", "poznań"), (), (), "pl", "PLN"),
    Country("AT", "eu", ("austria", "österreich", "vienna", "wien", "graz", "linz"), (), (), "at", "EUR"),
    Country("BE", "eu", ("belgium", "belgique", "belgië", "brussels", "bruxelles", "antwerp", "ghent"), (), (), "be", "EUR"),
    Country("IE", "eu", ("ireland", "dublin", "cork", "galway", "limerick")),
    Country("PT", "eu", ("portugal", "lisbon", "lisboa", "porto")),
    Country("SE", "eu", ("sweden", "sverige", "stockholm", "gothenburg", "göteborg", "malmö", "malmo")),
    Country("DK", "eu", ("denmark", "danmark", "copenhagen", "københavn", "aarhus")),
    Country("FI", "eu", ("finland", "suomi", "helsinki", "espoo", "tampere")),
    Country("CZ", "eu", ("czechia", "czech republic", "prague", "praha", "brno")),
    Country("RO", "eu", ("romania", "bucharest", "bucurești", "cluj", "cluj-napoca", "iasi")),
    Country("AE", "gulf", ("united arab emirates", "emirates", "dubai", "abu dhabi", "sharjah"), ("UAE",), queried=True),
    Country("SA", "gulf", ("saudi arabia", "saudi", "riyadh", "jeddah", "dammam", "khobar", "al khobar", "neom"), ("KSA",), queried=True),
    Country("QA", "gulf", ("qatar", "doha"), queried=True),
    Country("KW", "gulf", ("kuwait",), queried=True),
    Country("BH", "gulf", ("bahrain", "manama"), queried=True),
    Country("OM", "gulf", ("oman", "muscat"), queried=True),
)
REGIONS = ("us", "uk", "eu", "gulf")


def _any(title: Column, fragments: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (title.contains(f) for f in fragments), F.lit(False))


def match_role(title: Column, roles: Sequence[Role] = ROLES, exclude: Sequence[str] = GLOBAL_EXCLUDE) -> Column:
    """First role in order that a title names and doesn't exclude; null if none, or if the title is excluded altogether."""
    t = normalize_title(title)
    found = F.when(_any(t, exclude), F.lit(None).cast("string"))
    for role in roles:
        found = found.when(_any(t, role.match) & ~_any(t, role.exclude), role.slug)
    return found


def is_relevant_title(title: Column, roles: Sequence[Role] = ROLES, exclude: Sequence[str] = GLOBAL_EXCLUDE, keywords: Sequence[str] = RELEVANT) -> Column:
    t = normalize_title(title)
    return F.coalesce(~_any(t, exclude) & (match_role(title, roles, exclude).isNotNull() | _any(t, keywords)), F.lit(False))


def _whole(terms: Sequence[str], flags: str) -> str:
    return f"(?{flags})(?<!\\w)(?:{'|'.join(re.escape(x) for x in sorted(terms, key=len, reverse=True))})(?!\\w)"


def _any_place(countries: Sequence[Country]) -> str:
    """Any name or code as a whole word, or a state code after a comma; of equal places the country earlier in order, then the longer term."""
    by_letter: dict[str, list[str]] = {}
    for c in countries:
        for terms, flags in ((c.aliases, "iu"), (c.codes, "")):
            for x in sorted(terms, key=len, reverse=True):
                by_letter.setdefault(x[0].lower(), []).append(f"(?{flags}:{re.escape(x)})")
    # a word is compared with the terms of its first letter only
    words = "|".join(f"(?=(?iu:{re.escape(letter)}))(?:{'|'.join(terms)})" for letter, terms in by_letter.items())
    states = "|".join(x for c in countries for x in c.state_codes)
    return f"(?U)(?:(?<!\\w)(?:{words})(?!\\w)" + (f"|,\\s*(?:{states})(?!\\w))" if states else ")")


def resolve_country(location: Column, countries: Sequence[Country] = COUNTRIES) -> Column:
    """Code of the country named first in a location; null if none is. Of equal places the earlier in order.

    One expression finds the first place, which tells its country.
    """

    def country(place: Column) -> Column:
        found = F.when(place == "", F.lit(None).cast("string"))
        for c in countries:
            if c.aliases:
                found = found.when(F.lower(place).isin(*(x.lower() for x in c.aliases)), c.code)
            if c.codes:
                found = found.when(place.isin(*c.codes), c.code)
            if c.state_codes:
                found = found.when(place.startswith(",") & F.regexp_replace(place, r"(?U)^,\s*", "").isin(*c.state_codes), c.code)
        for c in countries:  # letters that are equal in upper case alone
            if c.aliases:
                found = found.when(place.rlike(_whole(c.aliases, "iuU")), c.code)
        return found

    return F.transform(F.array(F.regexp_extract(location, _any_place(countries), 0)), country)[0]


def resolve_countries(rows: DataFrame, location: str, out: str = "country", countries: Sequence[Country] = COUNTRIES) -> DataFrame:
    """Adds the country of each row's location; each distinct location is resolved once and joined back."""
    names = rows.select(F.col(location).alias("_place")).where("_place is not null").distinct()
    known = names.withColumn(out, resolve_country(F.col("_place"), countries))
    return rows.join(known, rows[location] == known["_place"], "left").drop("_place")


def region_of(country: Column, countries: Sequence[Country] = COUNTRIES, other: str = "other") -> Column:
    """Region of a country code, in any case; `other` where it isn't listed."""
    found = F.lit(None).cast("string")
    for region in dict.fromkeys(c.region for c in countries):
        found = F.when(F.upper(country).isin(*(c.code for c in countries if c.region == region)), region).otherwise(found)
    return F.coalesce(found, F.lit(other))


def country_table(spark: SparkSession, countries: Sequence[Country] = COUNTRIES) -> DataFrame:
    """One row per country: code, region, market, currency, queried. Its size is the configuration's."""
    return spark.createDataFrame([(c.code, c.region, c.market, c.currency, c.queried) for c in countries], "code string, region string, market string, currency string, queried boolean")


def with_region(rows: DataFrame, country: str = "country", out: str = "region", countries: Sequence[Country] = COUNTRIES) -> DataFrame:
    """The lookup of regions as a join with the configured table."""
    table = country_table(rows.sparkSession, countries).select(F.col("code").alias("_code"), F.col("region").alias("_region"))
    return rows.join(F.broadcast(table), F.upper(F.col(country)) == F.col("_code"), "left").withColumn(out, F.coalesce("_region", F.lit("other"))).drop("_code", "_region")


def query_grid(spark: SparkSession, places: Sequence[str], roles: Sequence[str]) -> DataFrame:
    """Every configured place with every configured role."""
    a = spark.createDataFrame([(p,) for p in places], "place string")
    return a.crossJoin(F.broadcast(spark.createDataFrame([(r,) for r in roles], "role string")))


def in_order(values: Sequence[str], column: Column) -> Column:
    """Sort key for a fixed order of values; others come last."""
    at = F.array_position(F.array(*map(F.lit, values)), column)
    return F.when(at > 0, at).otherwise(len(values) + 1)
