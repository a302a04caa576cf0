"""Deeply nested records to flat child tables.

Shapes are described by a tree automaton over JSON: states accept leaves, objects by their keys' states, and lists of a state.
It is compiled into column expressions, so classification runs inside the JVM on Spark's VARIANT type. Each record is routed to
the subtypes of its variant. One parse and one explode give the elements of all subtypes with the supertype's keys (parent table,
parent key, path, own key and the key of the row above); a subtype table is a typed projection of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Leaf:
    """State of scalars, null among them."""


@dataclass(frozen=True)
class Node:
    """State of objects: keys that must be present, all of ``need`` and one of ``one_of``; ``states``: what a present key must satisfy."""

    need: tuple[str, ...] = ()
    states: tuple[tuple[str, object], ...] = ()
    one_of: tuple[str, ...] = ()


@dataclass(frozen=True)
class Many:
    """State of lists whose elements satisfy ``item``; a single element without a list, null or nothing satisfy it too."""

    item: object


def member(value: Column, key: str) -> Column:
    """The member of an object; null if it isn't there or ``value`` is no object."""
    return F.try_variant_get(value, f"$['{key}']", "variant")


def text_of(value: Column) -> Column:
    """A scalar as a string; null for null, objects and lists."""
    return F.try_variant_get(value, "$", "string")


def _is_nothing(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def as_list(value: Column) -> Column:
    """Array of variants: a list's elements, a single value as a list of one, nothing for null."""
    listed = F.try_variant_get(value, "$", "array<variant>")
    return F.when(listed.isNotNull(), listed).when(_is_nothing(value), F.array().cast("array<variant>")).otherwise(F.array(value))


def accepts(state: object, value: Column) -> Column:
    """Whether the automaton, started in ``state``, accepts ``value``; never null."""
    if isinstance(state, Leaf):
        return _is_nothing(value) | F.try_variant_get(value, "$", "string").isNotNull()
    if isinstance(state, Many):
        return F.forall(as_list(value), lambda x: accepts(state.item, x))
    found = F.try_variant_get(value, "$", "map<string,variant>").isNotNull()
    for key in state.need:
        found = found & member(value, key).isNotNull()
    if state.one_of:
        found = found & F.coalesce(*[member(value, key) for key in state.one_of]).isNotNull()
    for key, inner in state.states:
        found = found & (member(value, key).isNull() | accepts(inner, member(value, key)))
    return F.coalesce(found, F.lit(False))


def classify(value: Column, variants: Sequence[tuple[str, object]]) -> Column:
    """Name of the first variant whose state accepts ``value``; ``other`` if none does, null for a null."""
    ladder = F
    for name, state in variants:
        ladder = ladder.when(accepts(state, value), name)
    return F.when(value.isNotNull(), ladder.otherwise("other"))


def parse_document(text: Column) -> Column:
    """JSON as VARIANT; a document encoded as a string again is decoded; null for nulls, blanks and what is broken."""
    once = F.try_parse_json(text)
    inner = F.try_variant_get(once, "$", "string")
    return F.when(F.ltrim(text).startswith('"'), F.try_parse_json(inner)).otherwise(once)


#: A step of a path: the keys to descend by, then a list to spread.
Step = tuple[str, ...]


@dataclass(frozen=True)
class Subtype:
    """A child table: lists to spread one within the other, the subtype of the row above (one list less), and typed columns.

    ``value`` names the keys of the element's own value; with ``members`` each member of the element is a row, ``key=value``.
    """

    name: str
    parent: str | None
    steps: tuple[Step, ...]
    value: Step | None = None
    columns: tuple[tuple[str, Step, str], ...] = ()
    members: bool = False


_ENTRY = "array<struct<child:string,parent:string,child_path:string,name:string,element:variant>>"


def descend(value: Column, names: Step) -> Column:
    for name in names:
        value = member(value, name)
    return value


def subtype_entries(document: Column, subtype: Subtype) -> Column:
    """Array of structs (child, parent, child_path, name, element) of one subtype; elements without any content are there too."""

    def entry(path: Column | None, name: Column, element: Column) -> Column:
        return F.struct(
            F.lit(subtype.name).alias("child"), F.lit(subtype.parent).cast("string").alias("parent"), (F.lit("") if path is None else path).alias("child_path"), name.alias("name"), element.alias("element")
        )

    def spread(value: Column, steps: tuple[Step, ...], path: Column | None) -> Column:
        if not steps:
            if subtype.members:
                pairs = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
                return F.coalesce(F.transform(pairs, lambda e: entry(path, e.key, e.value)), F.array().cast(_ENTRY))
            return F.array(entry(path, F.lit(None).cast("string"), value))
        inner = as_list(descend(value, steps[0]))
        place = lambda i: i.cast("string") if path is None else F.concat(path, F.lit("."), i.cast("string"))
        return F.flatten(F.transform(inner, lambda x, i: spread(x, steps[1:], place(i))))

    return spread(document, subtype.steps, None)


def route(by_variant: dict[str, list[Column]]) -> Column:
    """The entries of the subtypes of a record's variant; ``other`` (odd elements, mixed generations) goes through all."""
    ladder = F
    for variant, entries in by_variant.items():
        ladder = ladder.when(F.col("variant") == variant, F.concat(*entries) if entries else F.array().cast(_ENTRY))
    return ladder.when(F.col("variant") == "other", F.concat(*[e for entries in by_variant.values() for e in entries]))


def elements(documents: DataFrame, parent_table: str, entries: Column) -> DataFrame:
    """(parent_table, parent_key, child, child_path, name, element, row_key, parent_row_key): a row per element of every subtype.

    ``row_key`` is table, key, subtype and path; ``parent_row_key`` that of the element above, or of the record itself.
    """
    rows = documents.select(F.lit(parent_table).alias("parent_table"), F.col("parent_key").cast("string").alias("parent_key"), F.explode(entries).alias("e")).select("parent_table", "parent_key", "e.*")
    record = F.concat_ws("/", "parent_table", F.coalesce("parent_key", F.lit("")))
    above = F.regexp_replace("child_path", r"\.?[0-9]+$", "")
    return rows.withColumns(
        {
            "row_key": F.concat_ws("/", record, "child", F.nullif("child_path", F.lit("")), "name"),
            "parent_row_key": F.when(F.col("parent").isNull(), record).otherwise(F.concat_ws("/", record, "parent", above)),
        }
    ).drop("parent")


def child_rows(documents: DataFrame, parent_table: str, entries: Column, subtypes: Sequence[Subtype]) -> DataFrame:
    """Rows (parent_table, parent_key, child, child_path, child_value), positions from 0 joined by dots.

    Elements without the value have no row here, but they have one in their subtype table. Repeated elements have a row each.
    """
    rows = documents.select(F.lit(parent_table).alias("parent_table"), F.col("parent_key").cast("string").alias("parent_key"), F.explode(entries).alias("e")).select("parent_table", "parent_key", "e.*")
    by_paths: dict[tuple[Step, ...], list[str]] = {}
    for name in dict.fromkeys(s.name for s in subtypes):
        by_paths.setdefault(tuple(dict.fromkeys(() if s.members else s.value for s in subtypes if s.name == name)), []).append(name)
    ladder = F
    for paths, names in by_paths.items():
        value = F.coalesce(*[text_of(descend(F.col("element"), path)) for path in paths])
        ladder = ladder.when(F.col("child").isin(*names), F.when(F.col("name").isNull(), value).otherwise(F.concat("name", F.lit("="), value)))
    return rows.select("parent_table", "parent_key", "child", "child_path", ladder.otherwise(None).alias("child_value")).where("child_value is not null")


def subtype_table(rows: DataFrame, name: str, subtypes: Sequence[Subtype]) -> DataFrame:
    """The typed table of one subtype: keys, path, and its columns (null where a member is missing or of another type)."""
    own = [s for s in subtypes if s.name == name]
    typed = []
    for c in dict.fromkeys(c for s in own for c, _, _ in s.columns):
        places = dict.fromkeys((path, kind) for s in own for n, path, kind in s.columns if n == c)
        typed.append(F.coalesce(*[F.try_variant_get(descend(F.col("element"), path), "$", kind) for path, kind in places]).alias(c))
    if any(s.members for s in own):
        typed += [F.col("name").alias("kind"), text_of(F.col("element")).alias("value")]
    return rows.where(F.col("child") == name).select("row_key", "parent_row_key", "parent_table", "parent_key", "child_path", *typed)


_LANG = Node(states=(("lang", Leaf()), ("value", Leaf())))
_REFERENCE = Node(states=(("url", Leaf()), ("tags", Many(Leaf()))))
_WEAKNESS = Node(states=(("description", Many(_LANG)),))

NVD_VARIANTS = (
    (
        "item_2",
        Node(
            states=(("id", Leaf()), ("descriptions", Many(_LANG)), ("weaknesses", Many(_WEAKNESS)), ("references", Many(_REFERENCE)), ("CVE_data_meta", Many(Many(Leaf())))),
            need=("id",),
        ),
    ),
    ("item_1", Node(need=("CVE_data_meta",), states=(("description", Node()), ("problemtype", Node()), ("references", Node())))),
)

_TEXT = (("lang", ("lang",), "string"), ("value", ("value",), "string"))
_URL, _TAG = (("url", ("url",), "string"),), (("tag", (), "string"),)
_NODE = (("operator", ("operator",), "string"), ("negate", ("negate",), "boolean"))
_METRIC = (("metric_type", ("type",), "string"), ("version", ("cvssData", "version"), "string"), ("base_score", ("cvssData", "baseScore"), "double"), ("base_severity", ("cvssData", "baseSeverity"), "string"))


def _match(key: str) -> tuple[tuple[str, Step, str], ...]:
    return (("criteria", (key,), "string"), ("vulnerable", ("vulnerable",), "boolean"), ("version_end_excluding", ("versionEndExcluding",), "string"))


NVD_SUBTYPES = {
    "item_2": (
        Subtype("description", None, (("descriptions",),), ("lang",), _TEXT),
        Subtype("weakness_entry", None, (("weaknesses",),), columns=(("entry_type", ("type",), "string"),)),
        Subtype("weakness", "weakness_entry", (("weaknesses",), ("description",)), ("value",), _TEXT),
        Subtype("reference", None, (("references",),), ("url",), _URL),
        Subtype("reference_tag", "reference", (("references",), ("tags",)), (), _TAG),
        Subtype("configuration", None, (("configurations",),), columns=(_NODE[0],)),
        Subtype("node", "configuration", (("configurations",), ("nodes",)), columns=_NODE),
        Subtype("cpe", "node", (("configurations",), ("nodes",), ("cpeMatch",)), ("criteria",), _match("criteria")),
        Subtype("metric", None, (("metrics", "cvssMetricV31"),), columns=_METRIC),
        Subtype("metric_3", None, (("metrics", "cvssMetricV30"),), columns=_METRIC),
    ),
    "item_1": (
        Subtype("description", None, (("description", "description_data"),), ("lang",), _TEXT),
        Subtype("weakness_entry", None, (("problemtype", "problemtype_data"),)),
        Subtype("weakness", "weakness_entry", (("problemtype", "problemtype_data"), ("description",)), ("value",), _TEXT),
        Subtype("reference", None, (("references", "reference_data"),), ("url",), _URL),
        Subtype("reference_tag", "reference", (("references", "reference_data"), ("tags",)), (), _TAG),
    ),
}
#: Subtypes that lie beside the item, in the whole document, in the older generation.
NVD_RAW_SUBTYPES = (
    Subtype("node", None, (("configurations", "nodes"),), columns=_NODE),
    Subtype("child_node", "node", (("configurations", "nodes"), ("children",)), columns=_NODE),
    Subtype("cpe", "node", (("configurations", "nodes"), ("cpe_match",)), ("cpe23Uri",), _match("cpe23Uri")),
    Subtype("cpe_of_child", "child_node", (("configurations", "nodes"), ("children",), ("cpe_match",)), ("cpe23Uri",), _match("cpe23Uri")),
)

_RANGE = Node(states=(("events", Many(Node())),))
_AFFECTED = Node(states=(("package", Node()), ("ranges", Many(_RANGE))))
_PE_KEYS, _FLOW_KEYS = ("sections", "imports", "packer", "sha1", "entropy"), ("src", "dst", "sport", "dport", "proto", "sbytes", "dbytes")
FEATURE_VARIANTS = (
    ("advisory", Node(one_of=("cwe_ids", "affected"), states=(("cwe_ids", Many(Leaf())), ("affected", Many(_AFFECTED))))),
    ("executable", Node(one_of=_PE_KEYS, states=(("imports", Many(Leaf())), ("sections", Many(Node()))))),
    ("flow", Node(one_of=_FLOW_KEYS, states=tuple((k, Leaf()) for k in _FLOW_KEYS))),
    ("list", Many(Leaf())),
)
FEATURE_SUBTYPES = {
    "advisory": (
        Subtype("cwe", None, (("cwe_ids",),), (), (("cwe_id", (), "string"),)),
        Subtype("alias", None, (("aliases",),), columns=(("alias", (), "string"),)),
        Subtype("affected", None, (("affected",),), ("package", "name"), (("package_name", ("package", "name"), "string"), ("ecosystem", ("package", "ecosystem"), "string"))),
        Subtype("version", "affected", (("affected",), ("versions",)), columns=(("version", (), "string"),)),
        Subtype("range", "affected", (("affected",), ("ranges",)), columns=(("range_type", ("type",), "string"),)),
        Subtype("range_event", "range", (("affected",), ("ranges",), ("events",)), members=True),
    ),
    "executable": (
        Subtype("executable", None, (), columns=(("sha1", ("sha1",), "string"), ("size", ("size",), "bigint"), ("entropy", ("entropy",), "double"), ("packer", ("packer",), "string"))),
        Subtype("section", None, (("sections",),), columns=(("section_name", ("name",), "string"), ("rsize", ("rsize",), "bigint"))),
        Subtype("section_flag", "section", (("sections",), ("flags",)), columns=(("flag", (), "string"),)),
        Subtype("import", None, (("imports",),), columns=(("library", (), "string"),)),
    ),
    "flow": (
        Subtype(
            "flow", None, (),
            columns=tuple((k, (k,), t) for k, t in (("src", "string"), ("dst", "string"), ("sport", "int"), ("dport", "int"), ("proto", "string"), ("state", "string"), ("sbytes", "bigint"), ("dbytes", "bigint"), ("dur", "double"), ("rate", "double"))),
        ),
    ),
    "list": (),
}


def nvd_documents(items: DataFrame) -> DataFrame:
    """parent_key, item, raw and variant of each row; cve in raw counts where cve is null, empty or broken.

    A JSON value of cve that is no object counts as broken, an object without members as empty. Items of no known variant get ``other``.
    """
    read = items.select(F.col("item_id").alias("parent_key"), parse_document(F.col("cve")).alias("own"), parse_document(F.col("raw")).alias("raw"))
    inner = member(F.col("raw"), "cve")
    inner = F.when(text_of(inner).isNotNull(), F.try_parse_json(text_of(inner))).otherwise(inner)
    has_members = F.size(F.map_keys(F.try_variant_get("own", "$", "map<string,variant>"))) > 0
    read = read.select("parent_key", "raw", F.when(has_members, F.col("own")).otherwise(inner).alias("item"))
    return read.withColumn("variant", classify(F.col("item"), NVD_VARIANTS))


def _nvd_entries(wanted: Sequence[str] | None) -> tuple[Column, list[Subtype]]:
    item, raw = F.col("item"), F.col("raw")
    keep = lambda subtypes: [s for s in subtypes if wanted is None or s.name in wanted]
    by_variant = {v: [subtype_entries(item, s) for s in keep(own)] for v, own in NVD_SUBTYPES.items()}
    by_variant["item_1"] += [subtype_entries(raw, s) for s in keep(NVD_RAW_SUBTYPES)]
    return route(by_variant), [s for own in (*NVD_SUBTYPES.values(), NVD_RAW_SUBTYPES) for s in own]


def _feature_entries(wanted: Sequence[str] | None) -> tuple[Column, list[Subtype]]:
    by_variant = {v: [subtype_entries(F.col("item"), s) for s in own if wanted is None or s.name in wanted] for v, own in FEATURE_SUBTYPES.items()}
    return route(by_variant), [s for own in FEATURE_SUBTYPES.values() for s in own]


def nvd_elements(items: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
    """Elements of all (or the wanted) subtypes of nvd_items; see elements."""
    return elements(nvd_documents(items), "nvd_items", _nvd_entries(wanted)[0])


def feature_elements(silver: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
    return elements(feature_documents(silver), "silver_records", _feature_entries(wanted)[0])


def nvd_table(items: DataFrame, name: str) -> DataFrame:
    """The typed table of one subtype of nvd_items. Tables of several subtypes should share one ``nvd_elements``, saved."""
    return subtype_table(nvd_elements(items, [name]), name, _nvd_entries(None)[1])


def feature_table(silver: DataFrame, name: str) -> DataFrame:
    return subtype_table(feature_elements(silver, [name]), name, _feature_entries(None)[1])


def flatten_nvd(items: DataFrame) -> DataFrame:
    """Child rows of nvd_items; see child_rows. Empty tables give no rows; other columns don't matter."""
    own = [s for subtypes in (*NVD_SUBTYPES.values(), NVD_RAW_SUBTYPES) for s in subtypes if s.value is not None]
    rows = child_rows(nvd_documents(items), "nvd_items", _nvd_entries([s.name for s in own])[0], own)
    return rows.withColumn("child", F.when(F.col("child") == "cpe_of_child", "cpe").otherwise(F.col("child")))


def feature_documents(silver: DataFrame) -> DataFrame:
    """parent_key, item and variant of each record_id's features_json; repeated deliveries count once: the first that was ingested.

    Rows without record_id are records of their own with a null key.
    """
    at = F.col("ingested_at") if "ingested_at" in silver.columns else F.lit(None).cast("timestamp").alias("ingested_at")
    rows = silver.where(F.length(F.trim("features_json")) > 2).select("record_id", "features_json", at)
    alone = F.when(F.col("record_id").isNull(), F.struct("ingested_at", "features_json"))
    first = rows.groupBy("record_id", alone.alias("alone")).agg(F.min(F.struct("ingested_at", "features_json")).alias("x"))
    read = first.select(F.col("record_id").alias("parent_key"), parse_document(F.col("x.features_json")).alias("item"))
    return read.withColumn("variant", classify(F.col("item"), FEATURE_VARIANTS))


def flatten_features(silver: DataFrame) -> DataFrame:
    """Child rows of silver_records.features_json. Rows without record_id are parents with a null key."""
    own = [s for subtypes in FEATURE_SUBTYPES.values() for s in subtypes if s.value is not None or s.members]
    return child_rows(feature_documents(silver), "silver_records", _feature_entries([s.name for s in own])[0], own)


def shapes(documents: DataFrame, document: str = "item") -> DataFrame:
    """(shape, variant, documents): distinct shapes, inferred bottom-up from the values, counted over all documents."""
    return documents.groupBy(F.schema_of_variant(document).alias("shape"), "variant").agg(F.count("*").alias("documents"))
