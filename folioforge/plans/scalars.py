"""Queries of the scalar functions: input SQL, Catalyst expression, DuckDB expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import unicode as U
from . import fixtures as fx

c = F.col
TITLES = """SELECT c_custkey AS k, CASE c_custkey % 6
  WHEN 0 THEN concat('Straße  Ärger ', c_name) WHEN 1 THEN concat('ﬁn Été ', c_mktsegment) WHEN 2 THEN '漢字' WHEN 3 THEN repeat(concat(c_name, ' '), 6)
  WHEN 4 THEN concat('  --', c_name, '!! Niño ') ELSE concat(c_mktsegment, ' & ', c_name) END AS s FROM {customer}"""


def _from(expression: str, table: str = "customer", key: str = "c_custkey") -> str:
    return f"SELECT {key} AS k, {expression} AS s FROM {{{table}}}"


def _joined(cells: Column) -> Column:
    return F.array_join(cells, "~")


_ROW = """CASE c_custkey % 4 WHEN 0 THEN concat('| ', c_name, ' |', c_mktsegment, '| 3 |') WHEN 1 THEN concat(c_name, '|x')
  WHEN 2 THEN '|---|:--:|' ELSE concat(' |', chr(9), c_name, chr(9), '||a|b') END"""
_DUCK_CELLS = r"list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(s, '^\s+|\s+$', '', 'g'), '^\|', ''), '\|$', ''), '|'), lambda v: regexp_replace(v, '^\s+|\s+$', '', 'g'))"
_SEP = "CASE c_custkey % 5 WHEN 0 THEN '|---|:---:|' WHEN 1 THEN '|--|--|' WHEN 2 THEN '|| |' WHEN 3 THEN concat('|', c_name, '|---|') ELSE '|---||----:|' END"
_NUM = """CASE c_custkey % 5 WHEN 0 THEN concat('**', CAST(c_custkey AS STRING), '**') WHEN 1 THEN CAST(c_custkey % 500 AS STRING) WHEN 2 THEN concat('  ', CAST(c_custkey AS STRING), ' ')
  WHEN 3 THEN concat('p. ', CAST(c_custkey AS STRING)) ELSE '12345' END"""
_RESIDUE = "CASE c_custkey % 5 WHEN 0 THEN ' <br> ' WHEN 1 THEN concat('<BR/>', CAST(c_custkey AS STRING)) WHEN 2 THEN '' WHEN 3 THEN concat('<br>', c_name) ELSE '99999' END"
_IMAGES = "concat('a ![', c_name, '](img/x/', CAST(c_custkey AS STRING), '.png) b ![](', CAST(c_custkey % 7 AS STRING), '.jpg) [no](link)')"
_TRAIT = "concat('Knockback, ', CASE c_custkey % 4 WHEN 0 THEN 'Shield' WHEN 1 THEN 'Rapid' WHEN 2 THEN 'Single' ELSE c_mktsegment END, '~', CASE c_custkey % 3 WHEN 0 THEN 'Breaker, Shock' WHEN 1 THEN 'Fire (2)' ELSE 'Shot' END)"
_NAME = "CASE c_custkey % 6 WHEN 0 THEN '*Pistols*' WHEN 1 THEN c_mktsegment WHEN 2 THEN c_name WHEN 3 THEN 'Combi-weapon (x)' WHEN 4 THEN '' ELSE 'long Pattern las' END"

#: key: (input SQL with k and s, Spark expression, DuckDB expression)
SCALARS: dict[str, tuple[str, Column | Callable[[], Column], str]] = {
    "x01_clean_inline": (_from("concat(' ', c_name, chr(9), chr(7), 'x', chr(10), ' ')"), lambda: X.clean_inline(c("s")), r"trim(regexp_replace(s, '[\x00-\x1f\x7f]', '', 'g'))"),
    "x02_clean_block": (_from("concat(c_name, chr(9), chr(7), chr(13), chr(10), 'z', chr(27))"), lambda: X.clean_block(c("s")), r"regexp_replace(s, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g')"),
    "x03_collapse_spaced_caps": (
        _from("concat('## C H A P T E R  ', CAST(c_custkey AS STRING), ' I O  ', CASE WHEN c_custkey % 2 = 0 THEN 'F O U R' ELSE 'xA B C' END)"),
        lambda: X.collapse_spaced_caps(c("s")),
        r"regexp_replace(regexp_replace(replace(replace(s, 'C H A P T E R', 'CHAPTER'), 'F O U R', 'FOUR'), '(\S) {2,}(\S)', '\1 \2', 'g'), '(\S) {2,}(\S)', '\1 \2', 'g')",
    ),
    "x04_slugify": (TITLES, lambda: U.slugify(c("s")), r"coalesce(nullif(rtrim(left(trim(regexp_replace(lower(regexp_replace(strip_accents(replace(replace(s, 'ﬁ', 'fi'), 'ß', '')), '[^\x00-\x7f]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '-'), 60), '-'), ''), 'section')"),
    "x05_normalize_title": (TITLES, lambda: U.normalize_title(c("s")), r"trim(regexp_replace(strip_accents(lower(replace(s, 'ﬁ', 'fi'))), '\s+', ' ', 'g'))"),
    "x06_index_key": (_from("concat(CAST(c_custkey % 9 AS STRING), CASE WHEN c_custkey % 2 = 0 THEN '. ' ELSE ') ' END, '**', c_name, '**  `', c_mktsegment, '`, é-')"), lambda: X.index_key(c("s")), r"lower(trim(regexp_replace(regexp_replace(regexp_replace(s, '[*_`#]', '', 'g'), '^\s*\d+[.)]\s*', ''), '[^0-9a-zA-Z]+', ' ', 'g')))"),
    "x07_strip_leaders": (_from("concat(c_name, ' ........ ', CAST(c_custkey AS STRING), ' , x··y…… ;')"), lambda: X.strip_leaders(c("s")), r"regexp_replace(trim(regexp_replace(regexp_replace(s, '[.·…]{2,}', ' ', 'g'), '\s+', ' ', 'g')), ' +([,.;:])', '\1', 'g')"),
    "x08_split_cells": (_from(_ROW), lambda: _joined(X.split_cells(c("s"))), f"array_to_string({_DUCK_CELLS}, '~')"),
    "x09_separator_row": (_from(_SEP), lambda: X.is_separator(X.split_cells(c("s"))), r"regexp_matches(replace(s, ' ', ''), '^\|?(:?-{3,}:?)?(\|(:?-{3,}:?)?)*$') AND regexp_matches(s, '-')"),
    "x10_page_number": (_from(_NUM), lambda: X.is_page_number(c("s"), F.lit(300)), r"regexp_matches(trim(s), '^\*{0,2}\d{1,4}\*{0,2}$') AND coalesce(try_cast(trim(trim(s), '*') AS INT) <= 300, false)"),
    "x11_excision_residue": (_from(_RESIDUE), lambda: X.is_residue(c("s")), r"regexp_matches(trim(regexp_replace(s, '(?i)<br\s*/?>', ' ', 'g')), '^(\d{1,4})?$')"),
    "x12_row_content": (_from("CASE c_custkey % 3 WHEN 0 THEN '| | |' WHEN 1 THEN concat('||', c_name) ELSE '||' END"), lambda: X.row_has_content(X.split_cells(c("s"))), "regexp_matches(s, '[^| ]')"),
    "x13_quote": (_from("concat('a\"', c_name, chr(92), 'b')"), lambda: X.quote(c("s")), "'\"' || replace(replace(s, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"') || '\"'"),
    "x14_wikilink": (_from("c_name"), lambda: X.wikilink(c("s"), F.concat(c("s"), F.lit("!"))), "'[[' || s || '|' || s || '!]]'"),
    "x15_is_bare": (_from("CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE concat('a/', c_name) END"), lambda: X.is_bare(c("s")), "NOT contains(s, '/')"),
    "x16_index_target": (_from("CASE c_custkey % 3 WHEN 0 THEN 'index' WHEN 1 THEN concat(c_name, '/index') ELSE concat(c_name, 'index') END"), lambda: X.is_index_target(c("s")), "s = 'index' OR ends_with(s, '/index')"),
    "x17_asset_path": (_from("concat('tpch', repeat('/x', CAST(c_custkey % 4 AS INT)))"), lambda: X.asset_path(c("s"), F.lit("a.png")), "repeat('../', length(s) - length(replace(s, '/', ''))) || 'assets/a.png'"),
    "x18_image_refs": (_from(_IMAGES), lambda: F.concat_ws("~", X.image_sentinels(c("s")), F.array_join(X.image_names(c("s")), ",")), r"regexp_replace(s, '!\[[^\]]*\]\((?:[^)]*/)?([^)/]+)\)', '![](ASSET:\1)', 'g') || '~' || array_to_string(regexp_extract_all(s, '!\[[^\]]*\]\((?:[^)]*/)?([^)/]+)\)', 1), ',')"),
    "x19_resolve_assets": (_from("concat('t', repeat('/y', CAST(c_custkey % 3 AS INT)))"), lambda: X.resolve_assets(F.concat(F.lit("see ![](ASSET:"), c("s"), F.lit(".png) and ![](http)")), c("s")), "'see ![](' || repeat('../', length(s) - length(replace(s, '/', ''))) || 'assets/' || s || '.png) and ![](http)'"),
    "x20_summary": (_from("concat('  ', c_name, chr(10), chr(9), ' ', c_mktsegment, '   end ')"), lambda: X.collapse_white(c("s")), r"trim(regexp_replace(s, '\s+', ' ', 'g'))"),
    "x21_fixed_names": (_from("lower(c_mktsegment)"), lambda: F.concat_ws("~", X.moc_path(c("s")), X.asset_dir(c("s")), X.segment(F.lit("01.02"), c("s"))), "s || '/' || s || '.md~' || s || '/assets~01.02-' || s"),
    "x23_trait_wrap": (_from(_TRAIT), lambda: X.splits_trait(F.substring_index(c("s"), "~", 1), F.substring_index(c("s"), "~", -1)), "regexp_matches(s, 'Shield~Breaker|Rapid~Fire|Single~Shot')"),
    "x24_name_subheader": (_from(_NAME), lambda: X.is_name_subheader(c("s")), r"s = '' OR regexp_matches(s, '^[*_]') OR contains(lower(s), 'combi-weapon') OR contains(lower(s), 'component') OR contains(lower(s), 'pattern') OR (upper(s) = s AND regexp_matches(s, '[A-Za-z]'))"),
    "s12_content_hash": ("SELECT doc_id AS k, text AS s FROM {documents}", lambda: F.sha2(c("s"), 256), "sha256(s)"),
}


def query(key: str) -> Callable[[SparkSession, str], DataFrame]:
    sql, expression, _ = SCALARS[key]
    return lambda spark, sf_dir: fx.run(spark, sf_dir, sql).select(c("k").cast("long").alias("k"), expression().alias("out"))


def oracle(key: str) -> str:
    sql, _, duck = SCALARS[key]
    return f"SELECT CAST(k AS BIGINT) AS k, {duck} AS out FROM ({fx.duck(sql)}) f"
