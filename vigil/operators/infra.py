"""Infrastructure: lookups fanned out from distinct hosts, registration documents, seeds, resumed runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.text import present


def looked_up(rows: DataFrame, key: str, dimension: DataFrame, default: dict[str, Column]) -> DataFrame:
    """rows with a dimension's columns: each distinct key is looked up once and fanned out; keys without an entry get the defaults."""
    found = rows.select(key).distinct().join(dimension, key, "left")
    wide = rows.join(found.withColumnRenamed(key, "__k"), F.col(key).eqNullSafe(F.col("__k")), "left").drop("__k")
    for c, value in default.items():
        wide = wide.withColumn(c, F.coalesce(F.col(c), value))
    return wide


def seed(*columns: Column) -> Column:
    """The first of alias columns that is there, trimmed; NA without one."""
    return F.coalesce(*[F.when(present(c), F.trim(c)) for c in columns], F.lit("NA"))


_CARD = "roles: array<string>, vcardArray: array<string>"
_REGISTRATION = f"events array<struct<eventAction: string, eventDate: string>>, nameservers array<struct<ldhName: string>>, entities array<struct<{_CARD}, entities: array<struct<{_CARD}>>>>"


def _field(entity: Column, name: str) -> Column:
    """The value of the first field of that name in an entity's card; null without one."""
    items = F.from_json(F.get(entity["vcardArray"], F.lit(1)), "array<array<string>>")
    return F.get(F.get(F.filter(items, lambda i: (F.size(i) >= 4) & (F.get(i, F.lit(0)) == name)), F.lit(0)), F.lit(3))


def _last(values: Column) -> Column:
    return F.get(F.reverse(F.filter(values, lambda x: x.isNotNull())), F.lit(0))


def registration(doc: Column) -> dict[str, Column]:
    """Fields of a registration document, NA where it has none: registrar, registrant and country by the entities' roles (the last that
    has one, a registrant within another entity before that entity itself), dates by the events' actions, name servers as they are."""
    d = F.from_json(doc, _REGISTRATION)
    entities = F.coalesce(d["entities"], F.from_json(F.lit("[]"), f"array<struct<{_CARD}, entities: array<struct<{_CARD}>>>>"))
    plays = lambda e, role: F.coalesce(F.array_contains(e["roles"], role), F.lit(False))
    own = lambda e, role, field: F.when(plays(e, role), _field(e, field))
    nested = lambda e: _last(F.transform(F.coalesce(e["entities"], F.from_json(F.lit("[]"), f"array<struct<{_CARD}>>")), lambda x: own(x, "registrant", "fn")))
    address = _last(F.transform(entities, lambda e: own(e, "registrant", "adr")))
    country = F.when(F.startswith(address, F.lit("{")), F.get_json_object(address, "$['country-name']")).when(F.startswith(address, F.lit("[")), F.nullif(F.get(F.from_json(address, "array<string>"), F.lit(6)), F.lit("")))
    when = lambda action: F.get(F.filter(d["events"], lambda e: e["eventAction"] == action), F.lit(0))["eventDate"]
    servers = F.filter(F.transform(d["nameservers"], lambda s: s["ldhName"]), lambda x: x.isNotNull() & (x != ""))
    values = {
        "registrar": _last(F.transform(entities, lambda e: own(e, "registrar", "fn"))),
        "registrant": _last(F.transform(entities, lambda e: F.coalesce(nested(e), own(e, "registrant", "fn")))),
        "country": country,
        "registered": when("registration"),
        "expires": when("expiration"),
        "name_servers": F.nullif(F.array_join(servers, ";"), F.lit("")),
    }
    return {n: F.coalesce(c, F.lit("NA")) for n, c in values.items()}


def with_fallback(main: dict[str, Column], other: dict[str, Column], allowed: Column) -> dict[str, Column]:
    """Fields of a registration, and where all of them are missing and it is allowed, those of a second source."""
    missing = ~F.exists(F.array(*main.values()), present)
    return {n: F.when(missing & allowed, F.when(present(other[n]), F.trim(other[n])).otherwise("NA")).otherwise(F.when(present(c), F.trim(c)).otherwise("NA")) for n, c in main.items()}


def age_days(registered: Column, now: Column) -> Column:
    """Days since a registration; -1 where its date can't be read."""
    at = F.try_to_timestamp(F.substring(registered, 1, 10), F.lit("yyyy-MM-dd"))
    return F.when(at.isNull(), -1).otherwise(F.greatest(F.lit(0), F.datediff(now, at)))


def endpoint(host: Column, endpoints: dict[str, str], default: str) -> Column:
    """The address that a host's registration is asked at: that of its last label, else the default."""
    known = F.create_map(*[F.lit(x) for e in endpoints.items() for x in e])
    return F.concat(F.coalesce(F.try_element_at(known, F.substring_index(F.lower(host), ".", -1)), F.lit(default)), host)


def resolved_addresses(answers: DataFrame) -> DataFrame:
    """(host, ips, dns_answer_count) of answers(host, pos, ip): the distinct addresses in the order in which they came."""
    firsts = answers.where(present(F.col("ip"))).groupBy("host", "ip").agg(F.min("pos").alias("pos"))
    return firsts.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "ip"))), lambda x: x["ip"]).alias("ips"), F.count("*").alias("dns_answer_count"))


def record_bundle(records: DataFrame) -> DataFrame:
    """(host, dns_records) of records(host, kind, value): 'kind:value' joined by ';', kinds A, NS, MX, CNAME first, NA without any."""
    place = F.array_position(F.array(*map(F.lit, ("A", "NS", "MX", "CNAME"))), F.col("kind"))
    listed = records.select("host", F.struct(F.when(place > 0, place).otherwise(9).alias("p"), "kind", "value").alias("r")).distinct()
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("r.value").isNotNull(), F.col("r")))), lambda r: F.concat(r["kind"], F.lit(":"), r["value"])), ";")
    return listed.groupBy("host").agg(F.coalesce(F.nullif(joined, F.lit("")), F.lit("NA")).alias("dns_records"))


def looked_up_with_cache(hosts: DataFrame, cache: DataFrame, now: Column, *, cool_down: float = 90.0) -> DataFrame:
    """Distinct hosts(host) with what to do: 'cached' if cache(host, ok, at) has a success, 'cooling' if it failed less than cool_down
    seconds ago, else 'ask'. Each host is asked once, however many rows wait for it."""
    last = cache.groupBy("host").agg(F.max("ok").alias("ok"), F.max(F.when(~F.col("ok"), F.col("at"))).alias("failed_at"))
    cooling = F.col("failed_at").isNotNull() & (now.cast("double") - F.col("failed_at").cast("double") < cool_down)
    return hosts.select("host").distinct().join(last, "host", "left").select("host", F.when(F.coalesce("ok", F.lit(False)), "cached").when(cooling, "cooling").otherwise("ask").alias("action"))


def remaining(rows: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a resumed run has still to do."""
    return rows.join(done.select(*keys).distinct(), list(keys), "left_anti")


def live_workers(beats: DataFrame, worker: str, order: str, ended: Column) -> DataFrame:
    """The last heartbeat of each worker whose last one isn't its end."""
    rest = [c for c in beats.columns if c not in (worker, order)]
    last = beats.withColumn("__end", ended).groupBy(worker).agg(F.max(F.struct(order, "__end", *rest)).alias("m"))
    return last.where(~F.col("m.__end")).select(worker, F.col(f"m.{order}").alias(order), *[F.col(f"m.{c}").alias(c) for c in rest])


def differing(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, problem): rows of one side alone, and the columns in which the sides differ, joined by '|'."""
    r = right.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__r_{c}") for c in columns])
    j = left.select(key, *columns).join(r, F.col(key) == F.col("__k"), "full")
    names = F.array_join(F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"__r_{c}")), c) for c in columns])), "|")
    problem = F.when(F.col("__k").isNull(), "left_only").when(F.col(key).isNull(), "right_only").otherwise(names)
    return j.select(F.coalesce(F.col(key), F.col("__k")).alias(key), problem.alias("problem")).where("problem <> ''")
