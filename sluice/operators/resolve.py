"""Name resolution of link and timestamp fields.

Both start from one row per dataset (its parameters) and its declared tables. The catalog becomes an inverted index
with one row per database, table and term, and one per database and term over all its tables; datasets probe it by
equality, so a dataset never multiplies with the tables or structs that share a term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice import messages as M
from sluice import schemas as S
from sluice.functions.text import after_dot, before_dot, bracketed, message, text_or_empty
from sluice.operators.rules import is_active, is_incremental, normalise_enums, violations
from sluice.operators.skew import never_broadcast

# Lists of names are built for faulty datasets only, and whole: no longer than a dataset's declared tables, a
# database's tables or a catalog's structs.
LINK, STAMP = "link", "timestamp"
INDEX = ("db_key", "table_key", "term")
# The table key of the rows that stand for a whole database; no table has an empty name.
ANYWHERE = ""
# The salt gives the index a shuffle of its own, which AQE needs to split the probes of a hot term.
SALTS = 2


def _probe(probes: DataFrame, index: DataFrame) -> DataFrame:
    """Every probe, with the columns of its index row or NULLs."""
    spread = probes.withColumn("__salt", F.pmod(F.xxhash64("dataset_id", "table_key"), F.lit(SALTS)).cast("int"))
    every = index.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return spread.join(every, [*INDEX, "__salt"], "left")


def _as_probe(role: str, table: Column, term: Column, db: Column | None = None) -> Column:
    key = F.lower(F.col("db") if db is None else db)
    return F.struct(F.lit(role).alias("role"), key.alias("db_key"), table.alias("table_key"), term.alias("term"))


# --- J3: does the field exist? --------------------------------------------------------------


def field_lookups(params: DataFrame) -> DataFrame:
    """The lookups the rules ask for: (dataset_id, kind, db, spec).

    The link field with the header method; the timestamp field with the data method and an
    incremental load. Blank fields are faults of other rules.
    """
    p = normalise_enums(params).filter(is_active())
    method = F.col("incremental_timestamp_method")
    link = text_or_empty("incremental_header_to_tables_link_field")
    stamp = text_or_empty("incremental_timestamp_field")
    by_data = (method == S.DATA_METHOD) & (F.col("load_type") == S.INCREMENTAL)
    kind = F.when(method == S.HEADER_METHOD, LINK).when(by_data, STAMP)
    return p.select(
        "dataset_id",
        kind.alias("kind"),
        text_or_empty("database_name").alias("db"),
        F.when(kind == LINK, link).otherwise(stamp).alias("spec"),
    ).filter(F.col("kind").isNotNull() & (F.col("spec") != ""))


def _path_index(catalog: DataFrame) -> DataFrame:
    """Tables (in any case, with an empty term) and their paths of at most one struct (tables as written)."""
    entries = F.array(
        F.struct(F.lower("table_name").alias("table_key"), F.lit("").alias("term")),
        F.struct(F.col("table_name").alias("table_key"), F.when(F.col("depth") <= 2, F.lower("path")).alias("term")),
    )
    listed = catalog.select(F.lower("db").alias("db_key"), F.explode(entries).alias("e")).select("db_key", "e.*")
    return listed.where(F.col("term").isNotNull()).groupBy(*INDEX).agg(F.lit(True).alias("known"))


def locate_param_field(lookups: DataFrame, declared: DataFrame, catalog: DataFrame) -> DataFrame:
    """The lookups, one per dataset, with ``qualified`` and ``found``.

    A table prefix is accepted in any case but then compared exactly; without a prefix any
    declared table of the dataset may hold the field.
    """
    head, rest, spec = before_dot("spec"), after_dot("spec"), F.lower("spec")
    named = F.array(_as_probe("table", F.lower(head), F.lit("")), _as_probe("named", head, F.lower(rest)))
    own = lookups.select("*", F.explode(named).alias("p"))
    tables = declared.select("dataset_id", "database_name", "table_name")
    others = lookups.join(tables, "dataset_id").select(
        *lookups.columns, _as_probe("declared", F.col("table_name"), spec, F.col("database_name")).alias("p")
    )
    met = _probe(own.unionByName(others).select(*lookups.columns, "p.*"), _path_index(catalog))
    known = F.coalesce("known", F.lit(False))
    summary = met.groupBy("dataset_id").agg(
        *[F.any_value(c).alias(c) for c in lookups.columns if c != "dataset_id"],
        *[F.max((F.col("role") == role) & known).alias(f"in_{role}") for role in ("table", "named", "declared")],
    )
    found = F.when(F.col("in_table"), F.col("in_named")).otherwise(F.col("in_declared"))
    return summary.select("dataset_id", "kind", "db", "spec", F.col("in_table").alias("qualified"), found.alias("found"))


def check_param_fields(params: DataFrame, declared: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rules 57 and 58: fields that J3 does not find, with the searched tables."""
    lost = locate_param_field(field_lookups(params), declared, catalog).filter("NOT found")
    full = declared.select("dataset_id", F.concat_ws(".", "database_name", "table_name").alias("name"))
    listed = (
        lost.join(full, "dataset_id", "left")
        .groupBy("dataset_id", "kind", "db", "spec", "qualified")
        .agg(F.array_sort(F.collect_set("name")).alias("declared"))
    )
    named = F.array(F.concat_ws(".", F.col("db"), before_dot("spec")))
    searched = F.when(F.col("qualified"), named).otherwise(F.col("declared"))
    tables = bracketed(searched)
    link = F.col("kind") == LINK
    text = F.when(link, message(M.LINK_NOT_FOUND, field=F.col("spec"), tables=tables)).otherwise(
        message(M.FIELD_NOT_FOUND, field=F.col("spec"), tables=tables)
    )
    return violations(listed, F.when(link, 57).otherwise(58), F.when(link, "link_field").otherwise("timestamp_field"), text)


# --- J4: which column path is meant? --------------------------------------------------------


def timestamp_specs(params: DataFrame) -> DataFrame:
    """(dataset_id, db, spec) of the incremental datasets."""
    p = normalise_enums(params).filter(is_incremental())
    return p.select(
        "dataset_id",
        text_or_empty("database_name").alias("db"),
        text_or_empty("incremental_timestamp_field").alias("spec"),
    )


def term_index(catalog: DataFrame) -> DataFrame:
    """(db_key, table_key, term, direct, tops, table): one row per term of a table, and one per term of a database.

    A term is what a spec may call a column: a top-level name, a 'struct.leaf' path (both ``direct``) or a bare leaf, with
    the distinct structs (``tops``) that have it. The empty term of a table gives its name.
    """
    path, leaf = F.lower("path"), F.when(F.col("depth") == 2, F.lower("leaf"))
    none = F.lit(None).cast("string")

    def entry(table: Column, term: Column, direct: Column, top: Column) -> Column:
        return F.struct(table.alias("table_key"), term.alias("term"), direct.alias("direct"), top.alias("top"))

    scopes = [F.lower("table_name"), F.lit(ANYWHERE)]
    entries = F.array(
        *[entry(s, path, F.lit(True), none) for s in scopes],
        *[entry(s, leaf, F.lit(False), F.col("top")) for s in scopes],
        entry(scopes[0], F.lit(""), F.lit(False), none),
    )
    listed = catalog.filter(F.col("depth") <= 2).select(
        F.lower("db").alias("db_key"), F.col("table_name").alias("name"), F.explode(entries).alias("e")
    )
    return (
        listed.select("db_key", "name", "e.*")
        .where(F.col("term").isNotNull())
        .groupBy(*INDEX)
        .agg(F.max("direct").alias("direct"), F.collect_set("top").alias("tops"), F.min("name").alias("table"))
    )


def term_probes(specs: DataFrame, candidates: DataFrame) -> DataFrame:
    """What each dataset asks the index: one row per candidate table; without any, the database and the named table.

    On the table a spec is qualified with, the term is the remainder; elsewhere the whole spec.
    """
    head, rest, spec = F.lower(before_dot("spec")), after_dot("spec"), F.col("spec")
    table = F.lower("table_name")
    named = F.coalesce(table == head, F.lit(False))
    own = F.array(
        F.when(named, _as_probe("named", table, F.lower(rest))).otherwise(_as_probe("other", table, F.lower(spec)))
    )
    bare = F.array(
        _as_probe("other", F.lit(ANYWHERE), F.lower(spec)), _as_probe("named", head, F.lower(rest)), _as_probe("table", head, F.lit(""))
    )
    rows = specs.join(never_broadcast(candidates.select("dataset_id", "table_name", "first_row")), "dataset_id", "left")
    asked = F.when(F.col("table_name").isNotNull(), own).otherwise(bare)
    return rows.select("*", F.explode(asked).alias("p")).select(*rows.columns, "p.*")


def resolve_timestamp_field(specs: DataFrame, candidates: DataFrame, catalog: DataFrame) -> DataFrame:
    """(dataset_id, db, spec, table_name, resolved, outcome, candidates).

    ``specs`` is (dataset_id, db, spec); ``candidates`` is (dataset_id, table_name, first_row), and a
    dataset without any searches all tables of its database. ``resolved`` is
    'field' or 'struct.field' without a table prefix; ``outcome`` is resolved, blank, ambiguous or
    not_found; ``table_name`` is set when the spec is qualified with it. ``candidates`` are the
    distinct struct paths the spec may mean: never more than the catalog has structs.
    """
    met = _probe(term_probes(specs, candidates), term_index(catalog))
    on_named, other = F.col("role") == "named", F.col("role") == "other"
    direct = F.coalesce("direct", F.lit(False))
    own_table = F.when(on_named, F.col("table_name"))

    def tops(where: Column) -> Column:
        return F.array_distinct(F.flatten(F.collect_set(F.when(where & (F.size("tops") > 0), F.col("tops")))))

    r = met.groupBy("dataset_id").agg(
        F.any_value("db").alias("db"),
        F.any_value("spec").alias("spec"),
        F.coalesce(
            F.min_by(own_table, F.when(own_table.isNotNull(), F.col("first_row"))), F.max(F.when(F.col("role") == "table", F.col("table")))
        ).alias("table_name"),
        F.max(on_named & direct).alias("named_direct"),
        F.max(other & direct).alias("other_direct"),
        tops(on_named).alias("named_tops"),
        tops(other).alias("other_tops"),
    )
    qualified = F.col("table_name").isNotNull()
    target = F.when(qualified, after_dot("spec")).otherwise(F.col("spec"))
    structs = F.when(qualified, F.col("named_tops")).otherwise(F.col("other_tops"))
    r = r.withColumns(
        {
            "direct": F.when(qualified, F.col("named_direct")).otherwise(F.col("other_direct")),
            "candidates": F.array_sort(F.transform(structs, lambda top: F.concat_ws(".", top, target))),
        }
    )
    outcome = (
        F.when(F.col("spec") == "", "blank")
        .when(F.col("direct") | (F.size("candidates") == 1), "resolved")
        .when(F.size("candidates") > 1, "ambiguous")
        .otherwise("not_found")
    )
    path = F.when(F.col("direct"), target).otherwise(F.get("candidates", F.lit(0)))
    resolved = F.when(F.col("outcome") == "resolved", path)
    return r.withColumn("outcome", outcome).select(
        "dataset_id", "db", "spec", "table_name", resolved.alias("resolved"), "outcome", "candidates"
    )


def check_timestamp_field(params: DataFrame, candidates: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rule 70: specs that J4 does not resolve, with their candidates or scanned tables."""
    specs = timestamp_specs(params)
    r = resolve_timestamp_field(specs, candidates, catalog).filter(F.col("outcome") != "resolved")
    qualified = F.col("table_name").isNotNull()
    columns = [F.any_value(c).alias(c) for c in r.columns if c != "dataset_id"]
    entry = F.struct("first_row", F.col("own_table").alias("name"))
    own = candidates.select("dataset_id", F.col("table_name").alias("own_table"), "first_row")
    r = r.join(own, "dataset_id", "left").groupBy("dataset_id").agg(
        *columns, F.array_sort(F.collect_set(F.when(F.col("own_table").isNotNull(), entry))).alias("own")
    )
    tables = catalog.groupBy(F.lower("db").alias("db_key")).agg(F.array_sort(F.collect_set("table_name")).alias("all_tables"))
    r = r.withColumn("db_key", F.lower("db")).join(tables, "db_key", "left")
    none = F.array().cast("array<string>")
    names = F.when(F.size("own") > 0, F.col("own.name")).otherwise(F.coalesce("all_tables", none))
    scanned = F.transform(names, lambda t: F.concat_ws(".", "db", t))
    paths = bracketed(F.col("candidates"))
    db, spec, table, rest = F.col("db"), F.col("spec"), F.col("table_name"), after_dot("spec")
    text = (
        F.when(F.col("outcome") == "blank", F.lit(M.SPEC_BLANK))
        .when(
            (F.col("outcome") == "ambiguous") & qualified,
            message(M.AMBIGUOUS_IN_TABLE, leaf=rest, db=db, table=table, paths=paths),
        )
        .when(
            F.col("outcome") == "ambiguous",
            message(M.AMBIGUOUS, leaf=spec, db=db, paths=paths),
        )
        .when(qualified, message(M.NOT_FOUND_IN_TABLE, db=db, table=table, field=rest))
        .otherwise(
            message(M.NOT_FOUND, db=db, field=spec, tables=bracketed(scanned))
        )
    )
    return violations(r, 70, "timestamp_field", text)
