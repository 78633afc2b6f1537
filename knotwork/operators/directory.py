"""Relations and facts of directory records (companies, organisations and people as nested JSON), family by family."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.functions import text as X

_DEAL = "acquired_day int, acquired_month int, acquired_year int, price_amount string, price_currency_code string"
SCHEMA = f"""name string, first_name string, last_name string, homepage_url string, blog_url string, twitter_username string, overview string, crunchbase_url string, updated_at string,
founded_day int, founded_month int, founded_year int, born_day int, born_month int, born_year int, offices array<struct<city string, latitude double, longitude double>>,
acquisition struct<{_DEAL.replace(" int", ": int").replace(" string", ": string")}, acquiring_company: struct<name: string, permalink: string>>,
acquisitions array<struct<{_DEAL.replace(" int", ": int").replace(" string", ": string")}, company: struct<name: string, permalink: string>>>,
competitions array<struct<competitor: struct<name: string, permalink: string>>>, providerships array<struct<title: string, is_past: boolean, provider: struct<name: string, permalink: string>>>,
relationships array<struct<title: string, is_past: boolean, person: struct<first_name: string, last_name: string, permalink: string>>>,
investments array<struct<funding_round: struct<funded_day: int, funded_month: int, funded_year: int, company: struct<name: string, permalink: string>>>>,
ipo struct<pub_day: int, pub_month: int, pub_year: int>, web_presences array<struct<title: string, external_url: string>>""".replace("city string, latitude double, longitude double", "city: string, latitude: double, longitude: double")

KINDS = ("company", "financial-organization", "service-provider", "person", "product")


def parse_records(df: DataFrame) -> DataFrame:
    """(key, kind, r, own): records (key 'kind/permalink', value JSON) with typed members; people need both names, others a name."""
    rows = df.select(F.substring_index("key", "/", 1).alias("kind"), F.substring(F.col("key"), F.instr("key", "/") + 1, F.lit(10**6)).alias("permalink"), F.from_json("value", SCHEMA).alias("r")).filter(F.col("kind").isin(*KINDS) & F.col("r").isNotNull())
    own = F.when(F.col("kind") == "person", F.concat(F.col("r.first_name"), F.lit(" "), F.col("r.last_name"))).otherwise(F.col("r.name"))
    return rows.select(X.permalink_to_name(F.col("permalink")).alias("key"), "kind", "r", own.alias("own")).filter("own is not null and own <> ''")


def _link(c: Column) -> Column:
    return F.concat(F.lit("[["), c, F.lit("]]"))


def relations(records: DataFrame) -> DataFrame:
    """(src, dst, category, subcategory, snippet, distance) in both directions, with the fixed distances of each family."""
    p = records
    org = p.filter(F.col("kind") != "person").filter(F.col("kind") != "product")
    own = _link(F.col("own"))
    made: list[DataFrame] = []

    def add(df: DataFrame, dst: Column, subcategory: str, snippet: Column, near, far: int, category: str = "BUSINESS") -> None:
        near = near if isinstance(near, Column) else F.lit(near)
        made.append(df.select(F.col("key").alias("src"), dst.cast("string").alias("dst"), F.lit(category).alias("category"), F.lit(subcategory).alias("subcategory"), snippet.alias("snippet"), near.alias("near"), F.lit(far).alias("far")))

    def dated(df: DataFrame, at: str, prefix: str, subcategory: str, said: Column, year: tuple[int, int] | None, day: tuple[int, int], category: str = "BUSINESS", source: str | None = None) -> None:
        """A relation to the year, and one to the day where it is known."""
        d, m, y = (F.col(f"{source or at}.{prefix}_{x}") for x in ("day", "month", "year"))
        known = df.filter(y.isNotNull())
        if year:
            add(known, y, subcategory, F.concat(said, F.lit(" in "), _link(y.cast("string"))), *year, category)
        full = X.date_string(d, m, y)
        add(known.filter(d.isNotNull() & m.isNotNull()), full, subcategory, F.concat(said, F.lit(" on "), _link(full)), *day, category)

    dated(org, "r", "founded", "FOUNDING_DATE", F.concat(own, F.lit(" was founded")), (40, 60), (10, 25))
    office = org.select("key", "own", F.explode("r.offices").alias("o")).filter("o.city <> ''")
    add(office, F.col("o.city"), "LOCATION", F.concat(own, F.lit(" has a location in "), _link(F.col("o.city"))), 50, 60)
    price = F.when(F.col("a.price_amount").isNotNull() & F.col("a.price_currency_code").isNotNull(), F.concat(F.lit(" for "), F.col("a.price_amount"), F.lit(" "), F.col("a.price_currency_code"))).otherwise("")
    when = F.when(F.col("a.acquired_year").isNotNull(), F.concat(F.lit(" in "), F.col("a.acquired_year").cast("string"))).otherwise("")
    for rows, other, verb, year in ((org.select("key", "own", F.col("r.acquisition").alias("a")), "acquiring_company", " was acquired by ", (50, 70)), (org.select("key", "own", F.explode("r.acquisitions").alias("a")), "company", " acquired ", (50, 60))):
        deals = rows.filter(F.col(f"a.{other}.name").isNotNull() & F.col(f"a.{other}.permalink").isNotNull())
        dated(deals, "a", "acquired", "ACQUISITION", F.concat(own, F.lit(verb), F.col(f"a.{other}.name"), price), year, (30, 50))
        add(deals, X.permalink_to_name(F.col(f"a.{other}.permalink")), "ACQUISITION", F.concat(own, F.lit(verb), _link(F.col(f"a.{other}.name")), price, when), 10, 10)
    rival = org.select("key", "own", F.explode("r.competitions").alias("c")).filter("c.competitor.name is not null and c.competitor.permalink is not null")
    add(rival, X.permalink_to_name(F.col("c.competitor.permalink")), "COMPETITION", F.concat(own, F.lit(" and "), _link(F.col("c.competitor.name")), F.lit(" are competitors")), 40, 40)
    help_ = org.select("key", "own", F.explode("r.providerships").alias("v")).filter("v.title <> '' and v.provider.name is not null and v.provider.permalink is not null")
    add(help_, X.permalink_to_name(F.col("v.provider.permalink")), "PROVIDER", F.concat(_link(F.col("v.provider.name")), F.when(F.col("v.is_past"), " used to provide ").otherwise(" provides "), F.lower("v.title"), F.lit(" services for "), own), 40, 30)
    staff = org.select("key", "own", F.explode("r.relationships").alias("e")).filter("e.person.first_name is not null and e.person.last_name is not null and e.person.permalink <> ''")
    job = F.coalesce("e.title", F.lit(""))
    job = F.when(job.startswith("Board"), F.concat(F.lit("on the "), job)).otherwise(job)
    article = F.when(job.contains(",") | job.rlike("^C[A-Z][A-Z]|Chair|^on "), "").when(job.rlike("(?i)^[aeiou]"), "an ").otherwise("a ")
    does = F.when(job == "", F.when(F.col("e.is_past"), " used to work").otherwise(" works")).otherwise(F.concat(F.when(F.col("e.is_past"), " was ").otherwise(" is "), article, job))
    person = _link(F.concat_ws(" ", "e.person.first_name", "e.person.last_name"))
    add(staff, X.permalink_to_name(F.col("e.person.permalink")), "EMPLOYEE", F.concat(person, does, F.lit(" at "), own), F.when(job.contains("ounder") | job.rlike("^C[A-Z][A-Z]"), 10).otherwise(50), 10)
    stake = org.select("key", "own", F.explode("r.investments").alias("i")).select("key", "own", F.col("i.funding_round").alias("f")).filter("f.company.name <> '' and f.company.permalink is not null")
    dated(stake, "f", "funded", "INVESTMENT", F.concat(own, F.lit(" invested in "), F.col("f.company.name")), None, (25, 40))
    year = F.when(F.col("f.funded_year").isNotNull(), F.concat(F.lit(" in "), F.col("f.funded_year").cast("string"))).otherwise("")
    add(stake, X.permalink_to_name(F.col("f.company.permalink")), "INVESTMENT", F.concat(own, F.lit(" invested in "), _link(F.col("f.company.name")), year), 10, 10)
    dated(org, "r.ipo", "pub", "INVESTMENT", F.concat(own, F.lit("'s I.P.O. was")), (50, 60), (40, 50))
    dated(p.filter("kind = 'person'"), "r", "born", "BIRTH", F.concat(own, F.lit(" was born")), (45, 70), (10, 50), "PERSON")
    all_ = made[0]
    for m in made[1:]:
        all_ = all_.unionByName(m)
    all_ = all_.filter(F.col("src") != F.col("dst"))
    both = F.array(F.struct("src", "dst", F.col("near").alias("distance")), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("far").alias("distance")))
    return all_.select(F.explode(both).alias("x"), "category", "subcategory", "snippet").select("x.src", "x.dst", "category", "subcategory", "snippet", "x.distance")


def facts(records: DataFrame) -> DataFrame:
    """(key, common_name, aliases, home_page, blog, twitter, linkedin, description, locations) of every record."""
    r = lambda c: F.when(F.trim(F.col(f"r.{c}")) != "", F.col(f"r.{c}"))
    linked = F.get(F.filter(F.coalesce("r.web_presences", F.array().cast("array<struct<title:string,external_url:string>>")), lambda w: w["title"].contains("LinkedIn")), F.lit(0))["external_url"]
    lower = F.when(F.lower("own") != F.col("own"), F.array(F.struct(F.lower("own").alias("name"), F.lit(5).alias("distance")))).otherwise(F.array().cast("array<struct<name:string,distance:int>>"))
    return records.select("key", F.col("own").alias("common_name"), lower.alias("aliases"), r("homepage_url").alias("home_page"), r("blog_url").alias("blog"), F.when(r("twitter_username").isNotNull(), F.concat(F.lit("http://twitter.com/"), "r.twitter_username")).alias("twitter"), linked.alias("linkedin"), r("overview").alias("description"), F.transform("r.offices", lambda o: F.struct(o["latitude"].alias("latitude"), o["longitude"].alias("longitude"))).alias("locations"))
