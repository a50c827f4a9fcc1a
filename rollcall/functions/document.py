"""
Inspection of fetched JSON documents.

Nothing published by strangers is given a schema: each document is parsed once into a
VARIANT and looked at key by key.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rollcall.constants import CANONICAL_TYPES, ENDPOINT_TYPE_KEYS, ENDPOINT_URL_KEYS, \
    MAX_ENDPOINTS, REGISTRY_CAIP_ID, SERVICE_LIST_KEYS, TYPE_KEYS
from rollcall.functions.staging import stage
from rollcall.functions.text import strip


def boxed_document(body: Column) -> Column:
    """
    The text as first element of a VARIANT array whose second element is the text's hash.

    The parser stops after the first value and ignores what follows, so a bare document could
    have a tail. In the box it is complete exactly if the element after it is the hash.
    """
    return F.try_parse_json(F.concat(F.lit("["), body, F.lit(","),
                                     F.xxhash64(body).cast("string"), F.lit("]")))


def unboxed_document(boxed: Column, body: Column) -> Column:
    """The document, NULL unless the whole text is one JSON value."""
    return F.when(F.try_variant_get(boxed, "$[1]", "bigint") == F.xxhash64(body),
                  F.try_variant_get(boxed, "$[0]", "variant"))


@F.pandas_udf(T.StringType())
def _finite_json(bodies: pd.Series) -> pd.Series:
    def rewrite(body):
        if body is None or ("NaN" not in body and "Infinity" not in body):
            return body
        try:
            return json.dumps(json.loads(body, parse_constant=lambda _: None))
        except ValueError:
            return body
    return bodies.map(rewrite)


def finite_json(body: Column) -> Column:
    """
    NaN and Infinity written as null, for documents that hold them.

    The JVM parser refuses these literals. This is the only Python step of the engine, and
    jobs run it only when asked for exact JSON acceptance.
    """
    return _finite_json(body)


# The functions below return SQL text over named columns and lambda variables. They nest
# deeply; as text a whole finding is one expression for the session to parse.

def _member(value: str, key: str) -> str:
    return f"""try_variant_get({value}, '$["{key}"]', 'variant')"""


def _object_test(value: str) -> str:
    """Only an object casts to a struct, whatever fields it has; nothing is copied."""
    return f"(try_variant_get({value}, '$', 'struct<_: variant>') IS NOT NULL)"


def _text_test(value: str) -> str:
    return f"coalesce(schema_of_variant({value}) = 'STRING', false)"


def _text(value: str) -> str:
    return f"try_variant_get({value}, '$', 'string')"


def _list(value: str) -> str:
    return f"try_variant_get({value}, '$', 'array<variant>')"


def _object(value: str) -> str:
    return f"try_variant_get({value}, '$', 'map<string,variant>')"


def json_category(doc: str) -> str:
    """not_json, json_not_object, or NULL for an object."""
    return f"CASE WHEN {doc} IS NULL THEN 'not_json' " \
           f"WHEN NOT {_object_test(doc)} THEN 'json_not_object' END"


def top_level_name(doc: str) -> str:
    """What the document is, for the failure detail of one that is not an object."""
    return f"""CASE WHEN startswith(schema_of_variant({doc}), 'ARRAY') THEN 'list'
        ELSE CASE schema_of_variant({doc}) WHEN 'STRING' THEN 'str' WHEN 'BIGINT' THEN 'int'
            WHEN 'BOOLEAN' THEN 'bool' WHEN 'VOID' THEN 'NoneType' ELSE 'float' END END"""


def type_field(doc: str) -> str:
    """The first type-like key holding a string, or a list that starts with one."""
    found = []
    for key in TYPE_KEYS:
        value = _member(doc, key)
        first = f"try_variant_get({doc}, '$[\"{key}\"][0]', 'variant')"
        found.append(f"CASE WHEN {_text_test(value)} THEN {_text(value)} "
                     f"WHEN {_text_test(first)} THEN array_join(transform(filter({_list(value)}, "
                     f"t -> {_text_test('t')}), t -> {_text('t')}), ',') END")
    return f"coalesce({', '.join(found)}, '')"


def registry_entries(doc: str) -> str:
    return f"coalesce({_list(_member(doc, 'registrations'))}, CAST(array() AS ARRAY<VARIANT>))"


def names_registry(entries: str, registry_id: str) -> str:
    return f"""exists({entries}, entry -> coalesce(contains(
        lower(to_json({_member('entry', 'agentRegistry')})), '{registry_id}'), false))"""


def service_list(doc: str) -> str:
    """Struct(key, value) of the first non-empty service list or object."""
    found = []
    for key in SERVICE_LIST_KEYS:
        value = _member(doc, key)
        found.append(f"""CASE WHEN try_variant_get({doc}, '$["{key}"][0]', 'variant') IS NOT NULL
            OR ({_object_test(value)} AND size({_object(value)}) > 0)
            THEN named_struct('key', '{key}', 'value', {value}) END""")
    return f"coalesce({', '.join(found)})"


def _first_text(item: str, keys: Sequence[str], allow_empty: bool = False) -> str:
    """The text of the first of the keys that has one; later keys are not looked at."""
    found = []
    for member in (_member(item, key) for key in keys):
        wanted = _text_test(member) + ("" if allow_empty else f" AND {_text(member)} <> ''")
        found.append(f"CASE WHEN {wanted} THEN {_text(member)} END")
    return f"coalesce({', '.join(found)}, '')"


def _entry(kind: str, url: str) -> str:
    return f"named_struct('kind', {kind}, 'url', {url})"


def service_members(service: str) -> str:
    """The entries of the object form as a map, NULL for a list."""
    value = f"{service}.value"
    return f"CASE WHEN {_object_test(value)} THEN {_object(value)} END"


def service_names(service: str, members: str, body: str) -> str:
    """
    The keys of the object form in document order.

    A VARIANT object keeps its keys sorted, so the order of an object's entries is read from
    the text; only documents that use the object form pay for that second look.
    """
    raw = f"try_element_at(from_json({body}, 'map<string,string>'), {service}.key)"
    return f"CASE WHEN {members} IS NOT NULL THEN array_distinct(json_object_keys({raw})) END"


def service_entries(service: str, members: str, names: str, study: bool = False) -> str:
    """
    array<struct(kind, url)> in document order.

    Members and names are columns: a function over arrays computes what stands in it anew for every
    entry and every use.
    """
    value = f"{service}.value"
    of_object = _entry(_first_text("item", ENDPOINT_TYPE_KEYS),
                       _first_text("item", ENDPOINT_URL_KEYS))
    of_text = _entry("''", _text("item"))
    from_list = f"""filter(transform({_list(value)}, item -> CASE
        WHEN {_object_test('item')} THEN {of_object}
        WHEN {_text_test('item')} THEN {of_text} END), entry -> entry IS NOT NULL)"""
    member = f"try_element_at({members}, key)"
    url = f"CASE WHEN {_text_test(member)} THEN {_text(member)} " \
          f"ELSE {_first_text(member, ENDPOINT_URL_KEYS, allow_empty=study)} END"
    named = f"transform({names}, key -> {_entry('key', url)})"
    return f"""CASE WHEN {members} IS NOT NULL THEN {named}
        WHEN {value} IS NOT NULL THEN {from_list} END"""


def service_count(service: str, members: str) -> str:
    """Entries without a URL count too."""
    value = f"{service}.value"
    return f"""coalesce(CASE WHEN {members} IS NOT NULL THEN size({members})
        WHEN {value} IS NOT NULL THEN size({_list(value)}) END, 0)"""


def _parsed(df: DataFrame, body: str, exact_json: bool) -> DataFrame:
    source = F.col(body)
    staged = df.withColumn("_body", finite_json(source) if exact_json else source)
    staged = staged.withColumn("_boxed", boxed_document(F.col("_body")))
    return staged.withColumn("_doc", unboxed_document(F.col("_boxed"), F.col("_body")))


def categorise_documents(df: DataFrame, body: str, exact_json: bool = False) -> DataFrame:
    """Add the column `json_category` alone: for those who do not need what is in a document."""
    return stage(_parsed(df, body, exact_json), {"json_category": F.expr(json_category("_doc"))}) \
        .drop("_body", "_boxed", "_doc")


def analyse_documents(df: DataFrame, body: str, canonical_types: Sequence[str] = CANONICAL_TYPES,
                      type_length: int = 400, study: bool = False, exact_json: bool = False,
                      registry_id: str = REGISTRY_CAIP_ID,
                      services_of_all: bool = True) -> DataFrame:
    """
    Add the column `analysis` for the document text in `body`.

    Everything later steps need is small, so the text itself can be dropped before the first
    shuffle. With services_of_all=False only documents that match the schema have their
    services listed, which is all that grading needs.
    """
    staged = _parsed(df, body, exact_json)
    # Plain projections: each of these columns is used more than once by the next, so none is copied
    # into it, and a document is not copied from step to step. Filters stop at the last step.
    staged = staged.withColumns({
        "_kind": F.expr(json_category("_doc")),
        "_type": F.expr(type_field("_doc")),
        "_regs": F.expr(registry_entries("_doc")),
    })
    raw_type = F.col("_type")
    staged = staged.withColumns({
        "_canonical": (raw_type != "") & F.lower(strip(raw_type)).isin(*canonical_types),
        "_matches": F.expr(names_registry("_regs", registry_id)),
    })
    wanted = "true" if services_of_all else "_canonical OR _matches"
    staged = staged.withColumn("_service", F.expr(
        f"CASE WHEN {wanted} THEN {service_list('_doc')} END"))
    staged = staged.withColumn("_members", F.expr(service_members("_service")))
    staged = staged.withColumn("_names", F.expr(service_names("_service", "_members", "_body")))
    staged = staged.withColumn("_entries", F.expr(
        f"coalesce({service_entries('_service', '_members', '_names', study)}, "
        "CAST(array() AS ARRAY<STRUCT<kind: STRING, url: STRING>>))"))
    staged = staged.withColumn("_urls", F.expr("filter(_entries.url, u -> u <> '')"))
    analysis = F.expr(f"""named_struct(
        'json_category', _kind,
        'top_level', CASE WHEN _kind = 'json_not_object' THEN {top_level_name('_doc')} END,
        'type_field_raw', substring(_type, 1, {type_length}),
        'type_is_canonical', _canonical,
        'registry_field_present', size(_regs) > 0,
        'registry_field_matches', _matches,
        'schema_match', _canonical OR _matches,
        'services_count', {service_count('_service', '_members')},
        'endpoints_total', size(_urls),
        'urls', slice(_urls, 1, {MAX_ENDPOINTS}),
        'service_types', substring(array_join(filter(_entries.kind, k -> k <> ''), '|'), 1, 300),
        'doc_sha256', sha2({body}, 256))""")
    return stage(staged, {"analysis": analysis}) \
        .drop("_body", "_boxed", "_doc", "_kind", "_type", "_regs", "_canonical", "_matches",
              "_service", "_members", "_names", "_entries", "_urls")
