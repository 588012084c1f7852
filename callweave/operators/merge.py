"""Identity and merging of listings: order matters, and a confirmed value is never lost.

Rows of one key fold in an explicit order. The rules of a column need no state but its own, except that a verified
older row keeps its metadata against an unverified newer one; so the fold is one ``aggregate`` over the key's rows,
sorted. A key has as many rows as listings of one call, which is few by nature; keys without a business key never
meet. The fold of two rows is also the merge of a stored row with an incoming one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callweave.functions.arrays import empty, merged_map, one, ordered_set
from callweave.functions.ids import content_hash, publisher_id
from callweave.functions.text import non_empty, ordered_containing

UNIONS = ("source_keys", "topics", "publisher_keywords", "domains")
FIRSTS = ("id", "url", "source_url", "journal", "discovered_via")
# How topics may have been found.
TOPIC_METHODS = ("publisher", "llm", "none")
# The journals of one publisher, in the order in which a call lists them.
PLOS_JOURNALS = (
    "PLOS Sustainability and Transformation", "PLOS Neglected Tropical Diseases", "PLOS Global Public Health", "PLOS Computational Biology", "PLOS Complex Systems", "PLOS Digital Health", "PLOS Mental Health",
    "PLOS Genetics", "PLOS Pathogens", "PLOS Medicine", "PLOS Biology", "PLOS Climate", "PLOS Water", "PLOS ONE",
)
VERIFIED = ("summary", "image_url", "image_alt", "topics_model", "topics_input_hash", "topics_updated_at", "metadata_checked_at")


def plos_names(journal: Column, journals: Column) -> Column:
    """The publisher's journals that any of the names holds, else the journal alone: an array."""
    named = F.array_join(ordered_set(one(journal), journals), " ")
    found = ordered_containing(list(PLOS_JOURNALS), named)
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.coalesce(non_empty(journal), F.lit("PLOS"))))


def merge_rows(current: Column, incoming: Column, names: Sequence[str] | dict[str, str]) -> Column:
    """The struct of two listings of one call, ``names`` being the columns of both; ``current`` came first.

    With types of the columns (``names`` as a dict) the content hash is made anew where the rows have one, and a row whose
    content is what it was keeps the time of its last change.

    The incoming row wins, but: ids and addresses keep their first non-empty value; lists and score maps are united; the
    first sight is the earliest; an unknown status, a missing deadline and an unverified state take nothing away; and
    where only the current row was verified, its metadata stay.
    """
    cur, inc = (lambda n: current[n]), (lambda n: incoming[n])
    out: dict[str, Column] = {n: inc(n) for n in names}
    has = set(names)
    for n in FIRSTS:
        if n in has:
            out[n] = F.coalesce(non_empty(cur(n)), inc(n))
    for n in UNIONS:
        if n in has:
            out[n] = ordered_set(cur(n), inc(n))
    if {"journal", "journals"} <= has:
        out["journals"] = ordered_set(one(out["journal"]), one(cur("journal")), one(inc("journal")), cur("journals"), inc("journals"))
    if "domain_scores" in has:
        out["domain_scores"] = F.when(cur("domain_scores").isNull(), inc("domain_scores")).when(inc("domain_scores").isNull(), cur("domain_scores")).otherwise(merged_map(cur("domain_scores"), inc("domain_scores")))
    if "metadata_checked_at" in has:
        keeps = cur("metadata_checked_at").isNotNull() & inc("metadata_checked_at").isNull()
        for n in VERIFIED:
            if n in has:
                out[n] = F.when(keeps, cur(n)).otherwise(out[n])
        if {"journal", "journals"} <= has:
            out["journals"] = F.when(keeps, ordered_set(one(out["journal"]), cur("journals"), out["journals"])).otherwise(out["journals"])
        if "publisher_keywords" in has:
            out["publisher_keywords"] = F.when(keeps, ordered_set(cur("publisher_keywords"))).otherwise(out["publisher_keywords"])
        if "topics" in has:
            own = ordered_set(cur("topics"))
            out["topics"] = F.when(keeps, F.when(F.size(own) > 0, own).otherwise(ordered_set(inc("topics")))).otherwise(out["topics"])
        if "topics_method" in has:
            out["topics_method"] = F.when(keeps, F.coalesce(cur("topics_method"), inc("topics_method"))).otherwise(out["topics_method"])
    if "first_seen" in has:
        out["first_seen"] = F.least(cur("first_seen"), inc("first_seen"))
    if "status" in has:
        silent = inc("status").isNull() | (inc("status") == "unknown")
        out["status"] = F.when(silent & cur("status").isin("open", "closed"), cur("status")).otherwise(inc("status"))
    if "deadline" in has:
        lost = cur("deadline").isNotNull() & inc("deadline").isNull()
        out["deadline"] = F.when(lost, cur("deadline")).otherwise(inc("deadline"))
        if "deadline_status" in has:
            unsaid = inc("deadline").isNull() & (inc("deadline_status").isNull() | (inc("deadline_status") == "not_checked")) & (cur("deadline_status") == "not_listed")
            out["deadline_status"] = F.when(lost, F.coalesce(cur("deadline_status"), F.lit("listed"))).when(unsaid, F.lit("not_listed")).otherwise(inc("deadline_status"))
            if "deadline_checked_at" in has:
                out["deadline_checked_at"] = F.when(lost | unsaid, cur("deadline_checked_at")).otherwise(inc("deadline_checked_at"))
    if {"journal", "journals"} <= has and has & {"publisher", "discovered_via"}:
        theirs = F.coalesce(out["publisher"] == "PLOS" if "publisher" in has else F.lit(False), F.lit(False)) | F.coalesce(out["discovered_via"] == "plos-collections" if "discovered_via" in has else F.lit(False), F.lit(False))
        listed = plos_names(out["journal"], out["journals"])
        out["journal"], out["journals"] = F.when(theirs, listed[0]).otherwise(out["journal"]), F.when(theirs, listed).otherwise(out["journals"])
    if "_merged" in has:
        out |= _joined_states(cur, inc, has)
    if "content_hash" in has and isinstance(names, dict):
        out["content_hash"] = content_hash(names, out.__getitem__)
        if "last_changed" in has:
            out["last_changed"] = F.when(out["content_hash"] == cur("content_hash"), cur("last_changed")).otherwise(inc("last_changed"))
    return F.struct(*[out[n].alias(n) for n in names])


# A fold in blocks needs what is associative. Of columns whose merge is not, the rows carry a state that is: the journals of
# rows from the last to the first and all lists; the last status that says something, and the last one; the last deadline
# with its state, the last state that was settled without one, and the last state.


def _states(names: set[str]) -> dict[str, Column]:
    """The states of a single row."""
    out: dict[str, Column] = {"_merged": F.lit(False)}
    if {"journal", "journals"} <= names:
        out |= {"_heads": one(F.col("journal")), "_lists": F.coalesce("journals", empty())}
    if "status" in names:
        out |= {"_said": F.when(F.col("status") != "unknown", F.col("status")), "_last": F.col("status")}
    if {"deadline", "deadline_status"} <= names:
        at = F.col("deadline_checked_at") if "deadline_checked_at" in names else F.lit(None).cast("string")
        dated, settled = F.col("deadline").isNotNull(), F.col("deadline_status") != "not_checked"
        state = F.struct(F.col("deadline_status").alias("status"), at.alias("at"))
        out |= {"_day": F.col("deadline"), "_dated": F.when(dated, state), "_settled": F.when(settled, state), "_state": state}
    return out


def _joined_states(cur: Callable[[str], Column], inc: Callable[[str], Column], has: set[str]) -> dict[str, Column]:
    """The states of two runs of rows, one after the other."""
    out: dict[str, Column] = {"_merged": F.lit(True)}
    if "_heads" in has:
        out |= {"_heads": F.array_distinct(F.concat(inc("_heads"), cur("_heads"))), "_lists": F.array_distinct(F.concat(cur("_lists"), inc("_lists")))}
    if "_said" in has:
        out |= {"_said": F.coalesce(inc("_said"), cur("_said")), "_last": inc("_last")}
    if "_day" in has:
        kept = F.struct(F.coalesce(cur("_dated")["status"], F.lit("listed")).alias("status"), cur("_dated")["at"].alias("at"))
        out |= {
            "_day": F.coalesce(inc("_day"), cur("_day")),
            "_dated": F.when(inc("_day").isNotNull(), inc("_dated")).when(cur("_day").isNotNull(), kept),
            "_settled": F.coalesce(inc("_settled"), cur("_settled")),
            "_state": inc("_state"),
        }
    return out


def _of_states(columns: list[str], names: set[str]) -> dict[str, Column]:
    """The columns that follow from the states, for rows that were merged."""
    merged, out = F.col("_merged"), {}
    if "_heads" in names:
        theirs = [F.coalesce(F.col(c) == v, F.lit(False)) for c, v in (("publisher", "PLOS"), ("discovered_via", "plos-collections")) if c in columns]
        free = ~(theirs[0] | theirs[-1]) if theirs else F.lit(True)
        out["journals"] = F.when(merged & free, ordered_set(one(F.col("journal")), F.col("_heads"), F.col("_lists"))).otherwise(F.col("journals"))
    if "_said" in names:
        out["status"] = F.when(merged, F.when(F.col("_said").isin("open", "closed"), F.col("_said")).otherwise(F.col("_last"))).otherwise(F.col("status"))
    if "_day" in names:
        state = F.when(F.col("_day").isNotNull(), F.col("_dated")).when(F.col("_settled.status") == "not_listed", F.col("_settled")).otherwise(F.col("_state"))
        out["deadline_status"] = F.when(merged, state["status"]).otherwise(F.col("deadline_status"))
        if "deadline_checked_at" in columns:
            out["deadline_checked_at"] = F.when(merged, state["at"]).otherwise(F.col("deadline_checked_at"))
    return out


#: Rows of a key that are folded from one list.
BLOCK = 1000


def _folded(df: DataFrame, keys: list[str], order: list[str], names: dict[str, str], kind: str) -> DataFrame:
    """``keys`` and ``r``: the rows ``r`` of each key merged in order."""
    rows = F.collect_list(F.struct(F.struct(*order).alias("o"), "r"))
    by_order = lambda a, b: F.when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1).otherwise(0)
    in_order = F.array_sort(rows, by_order) if "map<" in kind else F.sort_array(rows)  # maps cannot be compared
    packed = df.groupBy(*keys).agg(in_order.alias("rows"))
    merged = F.when(F.size("rows") == 1, F.col("rows")[0]["r"]).otherwise(
        F.aggregate(F.slice("rows", 2, F.size("rows")), F.col("rows")[0]["r"].cast(kind), lambda acc, x: merge_rows(acc, x["r"], names).cast(kind))
    )
    return packed.select(*keys, merged.alias("r"))


def _folds(rows: DataFrame, own: list[str], order: Sequence[str], columns: list[str]) -> DataFrame:
    """``own`` and ``columns``: the rows of each key, the columns ``own``, merged in order."""
    blocks = not {"metadata_checked_at", "content_hash"} & set(columns)
    if blocks:
        rows = rows.withColumns(_states(set(columns)))
    names = {c: t for c, t in rows.dtypes if c not in own}
    kind = rows.select(*names).schema.simpleString()
    rows = rows.select(*own, *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*names).alias("r"))
    places = [f"_o{i}" for i in range(len(order))]
    if blocks:
        line = Window.partitionBy(*own).orderBy(*places)
        rows = _folded(rows.withColumn("_b", F.floor((F.row_number().over(line) - 1) / BLOCK)), [*own, "_b"], places, names, kind)
        places = ["_b"]
    out = _folded(rows, own, places, names, kind).select(*own, "r.*")
    return (out.withColumns(_of_states(columns, set(names))) if blocks else out).select(*own, *columns)


def fold(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each key: its rows merged in order. Rows with a null key pass unchanged.

    Merging is associative but for rows that were verified (``metadata_checked_at``) or carry a hash of their content, which
    every step makes anew. Tables without these columns are folded in blocks of ``BLOCK`` consecutive rows, then block by
    block, so that no list grows with a hot key; both steps use the partitioning of the first. With
    those columns a key's rows are one list: listings of one call, few by nature.
    """
    columns = df.columns
    keyed = df
    for k in keys:
        keyed = keyed.where(F.col(k).isNotNull())
    loose = df.where(" or ".join(f"`{k}` is null" for k in keys))
    own = {f"_by_{k}": F.col(k) for k in keys}
    return _folds(keyed.withColumns(own), list(own), order, columns).select(columns).unionByName(loose)


def collapse_business_keys(df: DataFrame) -> DataFrame:
    """One row for each (publisher, publisher_id): rows merged in order of their id. Rows without the key stay as they are."""
    blank = F.coalesce(F.col("publisher"), F.lit("")) == ""
    none = F.coalesce(F.col("publisher_id"), F.lit("")) == ""
    free = df.where(blank | none)
    return fold(df.where(~(blank | none)), ["publisher", "publisher_id"], ["id"]).unionByName(free)


def business_key_owner(df: DataFrame, position: str) -> DataFrame:
    """(publisher, publisher_id, id): the id of the first row, by ``position``, that has the key."""
    keyed = df.where("publisher is not null and publisher <> '' and publisher_id is not null and publisher_id <> ''")
    return keyed.groupBy("publisher", "publisher_id").agg(F.min_by("id", F.struct(position, "id")).alias("id"))


def call_key(id_column: Column) -> Column:
    """The business key as one text; a row without one gets a key of its own, made of ``id_column``, so that such rows
    spread over all partitions and match nothing else."""
    return F.when(_has_key(), F.concat_ws("\0", "publisher", "publisher_id")).otherwise(F.concat(F.lit("\0\0"), id_column))


def _has_key() -> Column:
    return (F.coalesce(F.col("publisher"), F.lit("")) != "") & (F.coalesce(F.col("publisher_id"), F.lit("")) != "")


def key_ids(rows: DataFrame, stored: DataFrame, position: str) -> DataFrame:
    """(_key, _id): the id that the rows of a business key get: that of its owner in ``stored``, else ``_new`` of the first of
    ``rows``, which have ``_key`` (``call_key``) and ``_new``."""
    owner = business_key_owner(stored, position).select(call_key(F.col("id")).alias("_key"), F.col("id").alias("_owner"))
    # Within the run the first row of a key decides: an aggregate and a join, so that a large key is no window's burden.
    first = rows.where(_has_key()).groupBy("_key").agg(F.min_by("_new", F.struct(position, "_new")).alias("_first"))
    return owner.join(first, "_key", "full_outer").select("_key", F.coalesce("_owner", "_first").alias("_id"))


def adopt_ids(incoming: DataFrame, stored: DataFrame, new_id: Column, position: str) -> DataFrame:
    """``incoming`` with a column ``id``: the owner of its business key in ``stored``, else of the first incoming row
    that has the key, else ``new_id``."""
    rows = incoming.withColumn("_new", new_id).withColumn("_key", call_key(F.col("_new")))
    return rows.join(key_ids(rows, stored, position), "_key", "left").withColumn("id", F.coalesce("_id", "_new")).drop("_new", "_key", "_id")


def split_calls(names: DataFrame, rows: DataFrame, stored: DataFrame) -> DataFrame:
    """(_key): keys of calls whose id may occur under another key too, or in several stored rows without business key,
    or be null.

    All rows of any other id, incoming and stored, have one key. ``names``: ``key_ids`` of ``rows``; ``stored`` has ``_key``.
    """
    one_row = lambda df, i, n: df.select(F.col(i).alias("i"), "_key", F.lit(n).alias("n"))
    loose = rows.where(~_has_key() & F.col("_new").isNotNull()).select("_new", "_key").distinct()
    each = one_row(names.where("_id is not null"), "_id", 0).unionByName(one_row(loose, "_new", 0)).unionByName(one_row(stored.where(~_has_key() & F.col("id").isNotNull()), "id", 1))
    same = Window.partitionBy("i")
    split = each.withColumn("split", (F.min("_key").over(same) != F.max("_key").over(same)) | (F.sum("n").over(same) > 1)).where("split")
    unnamed = names.where("_id is null").select("_key").unionByName(stored.where("id is null and _key is not null").select("_key"))
    return split.select("_key").unionByName(unnamed).distinct()


def upsert_by_key(stored: DataFrame, incoming: DataFrame, position: str) -> DataFrame:
    """``upsert`` of the rows of ``incoming`` into ``stored`` collapsed by business key, for rows partitioned by ``_key``, which
    all rows of an id share: they are merged where they are."""
    columns = [c for c in stored.columns if c != "_key"]
    old, new = _folds(stored, ["_key"], ["id"], columns), _folds(incoming, ["_key"], [position], [*columns, position])
    both = old.select("_key", F.struct(*columns).alias("cur")).join(new.select("_key", F.struct(*columns).alias("inc")), "_key", "full_outer")
    return _merged(both, stored.select(columns))


def _merged(both: DataFrame, like: DataFrame) -> DataFrame:
    kind = like.schema.simpleString()
    merged = F.when(F.col("cur").isNull(), F.col("inc").cast(kind)).when(F.col("inc").isNull(), F.col("cur").cast(kind)).otherwise(merge_rows(F.col("cur"), F.col("inc"), dict(like.dtypes)).cast(kind))
    return both.select(merged.alias("m")).select("m.*")


def upsert(stored: DataFrame, incoming: DataFrame, position: str | None = None) -> DataFrame:
    """Stored rows with incoming ones merged in by id; several incoming rows of an id fold in order of ``position`` first."""
    names = dict(stored.dtypes)
    new = fold(incoming.select(*names, *([position] if position and position not in names else [])), ["id"], [position]).select(*names) if position else incoming.select(*names)
    both = stored.select("id", F.struct(*names).alias("cur")).join(new.select("id", F.struct(*names).alias("inc")), "id", "full_outer")
    return _merged(both, stored)


def carry_forward(incoming: DataFrame, stored: DataFrame, now: Column, today: Column) -> DataFrame:
    """Records made of raw rows with what is stored of them: identity, deadline and its state, journals, topics, metadata.

    ``incoming`` has id, title, url, status, deadline, raw_deadline_status and raw_deadline_checked_at, and any other column
    of a record; what it or ``stored`` has not counts as null. A listing that omits something takes nothing away.
    Columns of the result: what the two tables have of a record's columns, with a content hash and the time of the last
    change.
    """
    have, held = set(incoming.columns), set(stored.columns) - {"id"}
    rows = incoming.join(stored.select("id", *[F.col(c).alias(f"old_{c}") for c in sorted(held)]).withColumn("old", F.lit(True)), "id", "left")
    kinds = dict(stored.dtypes) | dict(incoming.dtypes)
    null = lambda c: F.lit(None).cast(kinds.get(c, "array<string>" if c in (*UNIONS, "journals") else "string"))
    new = lambda c: F.col(c) if c in have else null(c)
    old = lambda c: F.col(f"old_{c}") if c in held else null(c)
    known_row = F.coalesce("old", F.lit(False))
    out: dict[str, Column] = {c: new(c) for c in ("id", "title", "publisher", "venue_type", "collection_type", "url", "source_url", "source_section", "classification_method", "extraction_method", "submission_mode") if c in have}
    deadline = F.coalesce(new("deadline"), old("deadline"))
    same = old("deadline").isNotNull() & (old("deadline") == deadline)
    verified = (F.col("raw_deadline_status") == "not_listed") & F.col("raw_deadline_checked_at").isNotNull()
    state = F.when(old("deadline_status").isin("listed", "not_listed", "not_checked"), old("deadline_status")).otherwise("not_checked")
    out |= {
        "deadline": deadline,
        "deadline_status": F.when(deadline.isNotNull(), "listed").when(verified, "not_listed").when(known_row, state).otherwise("not_checked"),
        "deadline_checked_at": F.when(deadline.isNotNull(), F.when(same, old("deadline_checked_at")).otherwise(now)).when(verified, F.col("raw_deadline_checked_at")).when(known_row, old("deadline_checked_at")),
        "status": F.when((new("status") == "unknown") & old("status").isin("open", "closed"), old("status")).otherwise(new("status")),
        "first_seen": F.coalesce(old("first_seen"), today),
    }
    out |= {c: F.coalesce(new(c), old(c)) for c in ("summary", "image_url", "image_alt")}
    if "journal" in have:
        checked = old("metadata_checked_at").isNotNull()
        mine = F.when(F.size(F.coalesce(new("journals"), empty())) > 0, new("journals")).otherwise(one(new("journal")))
        out["journal"] = F.when(checked, F.coalesce(non_empty(old("journal")), new("journal"))).otherwise(new("journal"))
        out["journals"] = F.when(checked, ordered_set(one(out["journal"]), old("journals"), mine)).otherwise(ordered_set(one(out["journal"]), mine, old("journals")))
    if have & {"source_keys", "discovered_via"}:
        mine = F.when(F.size(F.coalesce(new("source_keys"), empty())) > 0, new("source_keys")).otherwise(one(new("discovered_via")))
        out["source_keys"] = ordered_set(old("source_keys"), mine)
        out["discovered_via"] = F.coalesce(old("discovered_via"), new("discovered_via"))
    if "publisher_id" in have:
        out["publisher_id"] = F.coalesce(non_empty(new("publisher_id")), non_empty(old("publisher_id")), publisher_id(new("url"), new("publisher")))
    if "domains" in have:
        out["domains"] = ordered_set(new("domains"), old("domains"))
    if "domain_scores" in have:
        out["domain_scores"] = F.when(old("domain_scores").isNull(), new("domain_scores")).when(new("domain_scores").isNull(), old("domain_scores")).otherwise(merged_map(old("domain_scores"), new("domain_scores")))
    if {"topics", "publisher_keywords"} & have:
        keywords = F.when(F.size(F.coalesce(new("publisher_keywords"), empty())) > 0, ordered_set(new("publisher_keywords"))).otherwise(ordered_set(old("publisher_keywords")))
        mine, theirs = ordered_set(new("topics")), ordered_set(old("topics"))
        either = lambda a, b: F.when(F.size(a) > 0, a).otherwise(b)
        method = F.when(old("topics_method").isin(*TOPIC_METHODS), old("topics_method")).otherwise("none")
        stayed = known_row & ((F.size(theirs) > 0) | old("topics_method").isin(*TOPIC_METHODS))
        out["publisher_keywords"] = keywords
        out["topics"] = F.when(F.size(keywords) > 0, either(mine, theirs)).when(stayed, either(theirs, mine)).otherwise(mine)
        out["topics_method"] = F.when(F.size(keywords) > 0, "publisher").when(stayed, method).otherwise("none")
    out |= {c: old(c) for c in ("metadata_checked_at", "topics_model", "topics_input_hash", "topics_updated_at") if c in held}
    made = rows.select(*[v.alias(c) for c, v in out.items()], old("content_hash").alias("_hash"), old("last_changed").alias("_changed"))
    hashed = made.withColumn("content_hash", content_hash(dict(made.dtypes)))
    changed = F.when(F.col("_hash") == F.col("content_hash"), F.col("_changed")).otherwise(now.cast(kinds.get("last_changed", "timestamp_ntz")))
    return hashed.withColumn("last_changed", changed).drop("_hash", "_changed")


def last_writer(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """One row for each key: the last by ``position``."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(position, *[c for c in rest if c == "id"])).alias("r")).select(*keys, "r.*").select(df.columns)


def first_writer(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """One row for each key: the first by ``position``."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(position, *[c for c in rest if c == "id"])).alias("r")).select(*keys, "r.*").select(df.columns)
