"""Named queries over the plain tables, each with the same query as DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import html, layout, paragraphs, profiling, reflow, toc
from quire.plans import books
from quire.plans.bundles import bundle, dry_run
from quire.profiles import BY_BOOK, PROFILE_A, PROFILE_B, SETTINGS, Profile, Settings, with_settings
from quire.sources import epub
from quire.sources import fixtures as X
from quire.sources.shared import own_folder, written
from quire.streaming import articles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BLANK = T.BLANK


def _strip(c: str) -> str:
    """DuckDB form of the white space rule."""
    return f"regexp_replace({c}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def _cjk(c: str) -> str:
    return f"coalesce(regexp_full_match({c}, '{T.CJK}'), false)"


def query(name: str, oracle: str | None = None):
    def put(f: Query) -> Query:
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return put


# ---------------------------------------------------------------- reflow and front matter

def _reflow(with_: str, source: str) -> str:
    return f"""with {with_}, a as (select doc_id, n, line as raw, {_strip('line')} as bare from {source}),
f as (select *, starts_with(bare, '```') as fence from a),
i as (select *, coalesce(sum(fence::int) over (partition by doc_id order by n rows between unbounded preceding and 1 preceding), 0) % 2 = 1 as inside from f),
s as (select *, fence or inside or bare = '' or regexp_matches(bare, '{reflow.BREAK}') as alone, case when fence or inside then raw else bare end as piece, not (fence or inside) and bare = '' as gone from i),
o as (select *, (alone or coalesce(lag(alone) over (partition by doc_id order by n), true))::int as opens from s),
g as (select *, sum(opens) over (partition by doc_id order by n) as island from o),
b as (select doc_id, island, string_agg(piece, ' ' order by n) as block from g where not gone group by all),
m as (select doc_id, string_agg(block, chr(10) || chr(10) order by island) as markdown from b group by doc_id)
"""


@query("reflow_marked", _reflow(X.SQL["marked"], "marked") + "select doc_id, markdown from m")
def reflow_marked(spark: SparkSession, sf: str) -> DataFrame:
    return reflow.reflowed(X.spark_marked(spark, sf))


def _front(spark: SparkSession, sf: str, body: DataFrame) -> DataFrame:
    docs = X.read(spark, sf, "documents").select("doc_id", "lang", "source")
    title = F.concat(F.lit("Document "), F.col("doc_id").cast("string"))
    path = F.concat_ws("/", T.clean_filename("source"), T.clean_filename(title))
    return bundle(body.join(docs, "doc_id"), F.col("source"), F.col("lang"), F.col("doc_id"), title, path, F.col("markdown"))


@query(
    "reflow_documents",
    _reflow(X.SQL["lines"], "lines")
    + "select m.doc_id, d.source || '/Document ' || m.doc_id || '/index.md' as rel_path, '---' || chr(10) || 'book: ' || d.source || chr(10) || 'category: ' || d.lang || chr(10) || 'order: ' || m.doc_id || chr(10) || 'title: Document ' || m.doc_id || chr(10) || '---' || chr(10) || chr(10) || m.markdown as markdown from m join documents d using (doc_id)",
)
def reflow_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as bundles: reflowed Markdown with front matter."""
    return _front(spark, sf, reflow.reflowed(X.spark_lines(spark, sf)))


@query("front_matter", "select c_custkey, '---' || chr(10) || 'book: ' || c_mktsegment || chr(10) || 'category: ' || c_nationkey || ' nation' || chr(10) || 'order: ' || c_custkey || chr(10) || 'title: ' || c_name || chr(10) || '---' || chr(10) || chr(10) as head from customer")
def front(spark: SparkSession, sf: str) -> DataFrame:
    c = X.read(spark, sf, "customer")
    return c.select("c_custkey", T.front_matter(F.col("c_mktsegment"), F.concat("c_nationkey", F.lit(" nation")), F.col("c_custkey"), F.col("c_name")).alias("head"))


@query("clean_filename", "select page_id, " + _strip("regexp_replace(url, '[\\\\/:*?\"<>|]', '_', 'g')") + " as name, regexp_replace(regexp_extract(url, '([^/]*)/*$', 1), '(.)\\.[^.]*$', '\\1') as stem from pages")
def clean_filename(spark: SparkSession, sf: str) -> DataFrame:
    return X.read(spark, sf, "pages").select("page_id", T.clean_filename("url").alias("name"), T.file_stem("url").alias("stem"))


# ---------------------------------------------------------------- outlines

_TOC = "with " + X.SQL["toc"] + ", e as (select *, greatest(page - 1, 0) as start from toc_pages), "
_ENDS = "ends as (select a.doc_id, a.pos, greatest(coalesce((select arg_min(b.start, b.pos) from e b where b.doc_id = a.doc_id and b.pos > a.pos and b.level <= a.level), n_pages) - 1, a.start) as \"end\" from e a join toc_docs using (doc_id)), "
_KIDS = "kids as (select doc_id, pos, coalesce(lead(level) over (partition by doc_id order by pos) > level, false) as has_children from e), "
# An ancestor: before, of a higher rank, with nothing of its rank or higher in between.
_UP = "up as (select n.doc_id, n.pos, a.pos as a_pos, a.level as a_level, a.title as a_title from {t} n join {t} a on a.doc_id = n.doc_id and a.pos < n.pos and a.level < n.level where not exists (select 1 from {t} m where m.doc_id = n.doc_id and m.pos > a.pos and m.pos < n.pos and m.level <= a.level)), "
_BAD = "(contains({0}, 'MIDDLE') or contains({0}, 'NATION_5'))"
_LIST = _UP.format(t="e") + "bad as (select doc_id, pos, " + _BAD.format("title") + " or exists (select 1 from up where up.doc_id = e.doc_id and up.pos = e.pos and " + _BAD.format("a_title") + ") as is_blacklisted from e), "
_KEPT = _LIST + "kept as (select e.* from e join bad using (doc_id, pos) where not is_blacklisted), " + _UP.format(t="kept").replace("up as", "up2 as")
_CATS = "cats as (select doc_id, pos, coalesce((select string_agg(a_title, '/' order by a_level) from up2 where up2.doc_id = kept.doc_id and up2.pos = kept.pos), '') as category from kept), "
_KIND = "kinds as (select kept.*, has_children, case when level = 2 or (level < 2 and not has_children) then 'file' when level < 2 then 'folder' else 'content' end as kind from kept join kids using (doc_id, pos)), "
_PATH = "paths0 as (select doc_id, pos, concat_ws('/', (select string_agg(" + "regexp_replace(a_title, '[\\\\/:*?\"<>|]', '_', 'g')" + ", '/' order by a_level) from up2 join kinds k on k.doc_id = up2.doc_id and k.pos = up2.a_pos and k.kind = 'folder' where up2.doc_id = kinds.doc_id and up2.pos = kinds.pos), regexp_replace(title, '[\\\\/:*?\"<>|]', '_', 'g')) as path from kinds), paths as (select doc_id, pos, case when row_number() over (partition by doc_id, path order by pos) > 1 then path || '_' || pos else path end as path from paths0) "


def _toc(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows, docs = X.spark_toc(spark, sf)
    return rows.join(docs, "doc_id"), docs


def _planned(spark: SparkSession, sf: str) -> DataFrame:
    return toc.plan(_toc(spark, sf)[0], X.BLACKLIST, 2)


@query("toc_children", _TOC + _KIDS.rstrip(", ") + " select doc_id, pos, has_children from kids")
def toc_children(spark: SparkSession, sf: str) -> DataFrame:
    return toc.with_children(_toc(spark, sf)[0]).select("doc_id", "pos", "has_children")


@query("toc_intervals", _TOC + _ENDS.rstrip(", ") + ' select e.doc_id, pos, title, start, "end" from e join ends using (doc_id, pos)')
def toc_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return toc.with_end(toc.entries(_toc(spark, sf)[0])).select("doc_id", "pos", "title", "start", "end")


@query("toc_blacklist", _TOC + _LIST.rstrip(", ") + " select doc_id, pos, is_blacklisted from bad")
def toc_blacklist(spark: SparkSession, sf: str) -> DataFrame:
    return toc.with_blacklist(_toc(spark, sf)[0], X.BLACKLIST).select("doc_id", "pos", "is_blacklisted")


@query("toc_categories", _TOC + _KEPT + _CATS.rstrip(", ") + " select doc_id, pos, category from cats")
def toc_categories(spark: SparkSession, sf: str) -> DataFrame:
    return toc.with_category(toc.with_blacklist(_toc(spark, sf)[0], X.BLACKLIST).filter("not is_blacklisted")).select("doc_id", "pos", "category")


@query("toc_paths", _TOC + _KIDS + _KEPT + _KIND + _PATH + " select doc_id, pos, path from paths")
def toc_paths(spark: SparkSession, sf: str) -> DataFrame:
    return _planned(spark, sf).select("doc_id", "pos", "path")


_PLAN = _TOC + _KIDS + _ENDS + _KEPT + _CATS + _KIND + _PATH
_PLAN_SELECT = ' select k.doc_id, k.pos, k.level, k.title, category, kind, path, k.start, "end", has_children, "end" - k.start + 1 as page_count, case when kind = \'file\' then case when level = 2 then \'level\' else \'leaf\' end end as reason from kinds k join ends using (doc_id, pos) join cats using (doc_id, pos) join paths using (doc_id, pos)'


@query("toc_plan", _PLAN + _PLAN_SELECT)
def toc_plan(spark: SparkSession, sf: str) -> DataFrame:
    return _planned(spark, sf).select("doc_id", "pos", "level", "title", "category", "kind", "path", "start", "end", "has_children", "page_count", "reason")


@query("toc_dry_run", "select doc_id, pos, kind, path, page_count, reason from (" + _PLAN + _PLAN_SELECT + ")")
def toc_dry_run(spark: SparkSession, sf: str) -> DataFrame:
    return dry_run(_planned(spark, sf))


@query("article_pages", "select doc_id, pos, title, cast(unnest(generate_series(start, \"end\")) as int) as page from (" + _PLAN + _PLAN_SELECT + ") where kind = 'file'")
def article_pages(spark: SparkSession, sf: str) -> DataFrame:
    return toc.article_pages(_planned(spark, sf))


@query("uncovered_pages", "with p as (" + _PLAN + _PLAN_SELECT + "), d as (select doc_id, n_pages from (with " + X.SQL["toc"] + " select * from toc_docs)) select doc_id, page from (select doc_id, cast(unnest(generate_series(0, n_pages - 1)) as int) as page from d) x where not exists (select 1 from p where p.doc_id = x.doc_id and kind = 'file' and x.page between start and \"end\")")
def uncovered_pages(spark: SparkSession, sf: str) -> DataFrame:
    return toc.uncovered_pages(_planned(spark, sf), _toc(spark, sf)[1])


def _nav(spark: SparkSession, sf: str) -> DataFrame:
    rows = _toc(spark, sf)[0]
    return rows.select("doc_id", "pos", "level", "title", F.concat(F.lit("text/"), F.col("pos") % 40, F.lit(".xhtml#a"), "pos").alias("href"), (F.col("level") < 3).alias("is_section"))


_NAV = "with " + X.SQL["toc"] + ", e as (select *, 'text/' || (pos % 40) || '.xhtml' as href from toc_pages), " + _UP.format(t="e") + "flat as (select doc_id, pos, href, title, coalesce((select string_agg(" + "regexp_replace(a_title, '[\\\\/:*?\"<>|]', '_', 'g')" + ", '/' order by a_level) from up where up.doc_id = e.doc_id and up.pos = e.pos), '') as category from e where level = 3), nav as (select doc_id, href, arg_max(title, pos) as title, arg_max(category, pos) as category from flat group by all)"


@query("nav_flatten", _NAV + " select * from nav")
def nav_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return toc.nav_entries(_nav(spark, sf))


@query("nav_join", _NAV + ", spine as (select d.doc_id, k as \"order\", 'text/' || k || '.xhtml' as href from toc_docs d, generate_series(1, 50) t(k)) select spine.doc_id, \"order\", spine.href, coalesce(nullif(nav.title, ''), cast(\"order\" as varchar)) as title, coalesce(nullif(category, ''), 'book') as category from spine left join nav on nav.doc_id = spine.doc_id and nav.href = spine.href")
def nav_join(spark: SparkSession, sf: str) -> DataFrame:
    spine = _toc(spark, sf)[1].select("doc_id", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(50).cast("long"))).alias("order")).withColumn("href", F.concat(F.lit("text/"), "order", F.lit(".xhtml")))
    found = spine.join(toc.nav_entries(_nav(spark, sf)), ["doc_id", "href"], "left")
    return found.select("doc_id", "order", "href", T.first_text("title", T.file_stem("href")).alias("title"), T.first_text("category", F.lit("book")).alias("category"))


# ---------------------------------------------------------------- lines

_SPANS = "with " + X.SQL["spans"]


def _nearest_case(size: str, p: Profile) -> str:
    """Fixed values far apart: at most one is closer than the tolerance."""
    return "case " + " ".join(f"when abs({size} - {s}) < 0.5 then '{x}'" for s, x in p.fonts) + " else '' end"


_LINES = _SPANS + f""", l as (select doc_id, page, line_idx, min(x0) as x0, min(y0) as y0, max(size) as max_size,
 bool_or(contains(lower(font), 'fang')) as has_fangsong, bool_or(not contains(lower(font), 'fang') and contains(lower(font), 'kai')) as has_kaiti,
 bool_or(not contains(lower(font), 'fang') and not contains(lower(font), 'kai') and regexp_matches(lower(font), 'hei|bold')) as has_heiti,
 string_agg(text, '' order by span_idx) as raw from spans group by all),
m as (select *, {_nearest_case('max_size', PROFILE_A)} as mapped from l),
p as (select *, case when starts_with(mapped, '#') then mapped when has_heiti and x0 > 120 then '### ' when has_fangsong then '> ' when mapped = '> ' and not has_kaiti and not has_heiti then '> ' else '' end as prefix from m)"""


def _prefixed(spark: SparkSession, sf: str, profile: Profile = PROFILE_A) -> DataFrame:
    return layout.with_prefix(layout.with_features(layout.lines(X.spark_spans(spark, sf)), profile), profile)


@query("font_nearest", _SPANS + f" select distinct size, {_nearest_case('size', PROFILE_A)} as prefix_a, {_nearest_case('size', PROFILE_B)} as prefix_b from spans")
def font_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return X.spark_spans(spark, sf).select("size").distinct().select("size", layout.nearest_prefix(F.col("size"), PROFILE_A).alias("prefix_a"), layout.nearest_prefix(F.col("size"), PROFILE_B).alias("prefix_b"))


@query("line_prefix", _LINES + " select doc_id, page, line_idx, max_size, has_fangsong, has_kaiti, has_heiti, mapped, prefix from p")
def line_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return _prefixed(spark, sf).select("doc_id", "page", "line_idx", "max_size", "has_fangsong", "has_kaiti", "has_heiti", "mapped", "prefix")


_BOLD, _ITALIC = "(flags & 16 <> 0 or regexp_matches(lower(font), 'hei|bold'))", "(flags & 2 <> 0 or contains(lower(font), 'kai'))"
_STYLED = f"case when {_strip('text')} = '' then text else regexp_extract(text, '^{BLANK}*', 0) || mark || {_strip('text')} || mark || regexp_extract(text, '{BLANK}*$', 0) end"


@query("inline_style", _SPANS + f", s as (select *, case when {_BOLD} and {_ITALIC} then '***' when {_BOLD} then '**' when {_ITALIC} then '*' else '' end as mark from spans) select doc_id, page, line_idx, span_idx, case when mark = '' then text else {_STYLED} end as styled from s")
def inline_style(spark: SparkSession, sf: str) -> DataFrame:
    return X.spark_spans(spark, sf).select("doc_id", "page", "line_idx", "span_idx", layout.styled(F.col("text"), F.col("flags"), F.col("font")).alias("styled"))


_NUMBERED = "'^([0-9.]+|[一二三四五六七八九十百]+[、.]?)[ \\t]+(.*)$'"


def _normalized(c: str) -> str:
    t = _strip(f"replace({c}, '　', ' ')")
    return f"case when regexp_matches({t}, {_NUMBERED}) then regexp_extract({t}, {_NUMBERED}, 1) || ' ' || replace(regexp_extract({t}, {_NUMBERED}, 2), ' ', '') else replace({t}, ' ', '') end"


_HEAD = "concat(case n % 3 when 0 then '一　' when 1 then '1.2  ' else '' end, line)"


@query("heading_normalize", "with " + X.SQL["lines"] + f", k as (select doc_id, n, {_strip(f"replace({_HEAD}, '　', ' ')")} as t from lines) select doc_id, cast(n as int) as n, case when regexp_matches(t, {_NUMBERED}) then regexp_extract(t, {_NUMBERED}, 1) || ' ' || replace(regexp_extract(t, {_NUMBERED}, 2), ' ', '') else replace(t, ' ', '') end as heading from k")
def heading_normalize(spark: SparkSession, sf: str) -> DataFrame:
    lead = F.when(F.col("n") % 3 == 0, "一　").when(F.col("n") % 3 == 1, "1.2  ").otherwise("")
    return X.spark_lines(spark, sf).select("doc_id", "n", T.normalized_heading(F.concat(lead, "line")).alias("heading"))


def _without_marks(c: str) -> str:
    for mark in ("接上页", "转下页"):
        c = f"regexp_replace({c}, '\\[{BLANK}*" + f"{BLANK}*".join(mark) + f"{BLANK}*\\]', '', 'g')"
    return c


def _line_texts(p: Profile) -> str:
    """Lines with their text, by one fold over each line's spans in order."""
    exact = ", ".join(str(x) for x, prefix in p.fonts if prefix.startswith("#"))
    never = "prefix in ('# ', '## ', '### ')" if p.heading_continues else "prefix = '### '"
    lines = _LINES.removeprefix(_SPANS).replace(_nearest_case("max_size", PROFILE_A), _nearest_case("max_size", p)).replace("x0 > 120", f"x0 > {p.centre}")
    return "with " + X.SQL["head_spans"] + lines + f""",
 s0 as (select s.doc_id, s.page, s.line_idx, span_idx, prefix, starts_with(prefix, '#') as head, {_without_marks('s.text')} as text, {_nearest_case('size', p)} = 'SUBTITLE' as subtitle, size in ({exact}) as header, case when {_BOLD} and {_ITALIC} then '***' when {_BOLD} then '**' when {_ITALIC} then '*' else '' end as mark from spans s join p using (doc_id, page, line_idx)),
 s1 as (select *, {_strip('text')} as bare from s0 where text <> ''),
 s2 as (select * replace (case when subtitle then '**' || bare || '**' else text end as text), length(bare) = 1 and not {_cjk('bare')} and not regexp_matches(bare, '^[\\p{{L}}\\p{{N}}]$') as sign, regexp_matches(bare, '^([①-⑩]|[0-9]+)$') as joins from s1),
 s3 as (select * replace (case when head or mark = '' then text else {_STYLED} end as text) from s2),
 s4 as (select doc_id, page, line_idx, any_value(prefix) as prefix, list({{'done': text, 'header': header, 'sign': sign, 'subtitle': subtitle, 'joins': joins}} order by span_idx) as parts from s3 group by all),
 s5 as (select *, {_strip("""(list_reduce(list_concat([{'done': '', 'header': starts_with(prefix, '#'), 'sign': false, 'subtitle': false, 'joins': false}], parts), lambda a, x: {
   'done': a.done || case when (a.header and not x.header and not x.sign and not (NEVER) and not x.joins) or (x.subtitle and (a.done <> '' or prefix <> '') and not ends_with(a.done, chr(10))) then chr(10) || chr(10) else '' end || x.done,
   'header': case when x.sign then a.header else x.header end, 'sign': false, 'subtitle': false, 'joins': false})).done""").replace("NEVER", never)} as body from s4)
 select doc_id, page, line_idx, prefix, case when body = '' then '' when starts_with(prefix, '#') then prefix || {_normalized('body')} when prefix = '> ' then '> ' || body else body end as text from s5"""


@query("heading_lines", f"select 'a' as profile, * from ({_line_texts(PROFILE_A)}) union all select 'b', * from ({_line_texts(PROFILE_B)})")
def heading_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of three spans in both profiles: breaks after headings and before subtitles, single marks and numbers that join."""

    def one(p: Profile) -> DataFrame:
        rows = layout.with_prefix(layout.with_features(layout.lines(X.spark_head_spans(spark, sf)), p), p).withColumn("refs_before", F.lit(0))
        return layout.with_text(rows, p).filter(F.exists("spans", lambda s: T.without_page_markers(s["text"]) != "")).select(F.lit(p.name).alias("profile"), "doc_id", "page", "line_idx", "prefix", "text")

    return one(PROFILE_A).unionByName(one(PROFILE_B))


_MARKED_LINE = "(case when n % 2 = 0 then '[ 接 上 页]' else '' end || line || case when n % 3 = 0 then '[转下页 ]' else '' end)"


@query("page_marker_clean", "with " + X.SQL["lines"] + f" select doc_id, cast(n as int) as n, {_without_marks(_MARKED_LINE)} as cleaned from lines")
def page_marker_clean(spark: SparkSession, sf: str) -> DataFrame:
    marked = F.concat(F.when(F.col("n") % 2 == 0, "[ 接 上 页]").otherwise(""), "line", F.when(F.col("n") % 3 == 0, "[转下页 ]").otherwise(""))
    return X.spark_lines(spark, sf).select("doc_id", "n", T.without_page_markers(marked).alias("cleaned"))


def _regions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pages, text blocks and drawings derived from lines."""
    rows = X.spark_lines(spark, sf, dealt=True).select("doc_id", F.floor(F.col("n") / 12.0).cast("int").alias("page"), (F.col("n") % 12).cast("int").alias("block_idx"), F.col("n"), F.col("line"))
    mark = F.when((F.col("n") % 12 == 2) & (F.col("n") % 7 == 0), "接上页").when((F.col("n") % 12 == 9) & (F.col("n") % 5 == 0), "————————").otherwise("")
    blocks = rows.select("doc_id", "page", "block_idx", (100.0 + 35 * F.col("block_idx")).alias("y0"), F.concat("line", mark).alias("text"))
    drawings = rows.filter("n % 12 = 10 and n % 3 = 0").select("doc_id", "page", F.lit(300.0).alias("x0"), (100.0 + 35 * F.col("block_idx")).alias("y0"), F.lit(370.0).alias("x1"), (101.0 + 35 * F.col("block_idx")).alias("y1"))
    return rows.select("doc_id", "page").distinct().withColumn("height", F.lit(595.0)), blocks, drawings


_REGIONS = "with " + X.SQL["lines"] + """, r as (select doc_id, cast(floor(n / 12.0) as int) as page, cast(n % 12 as int) as block_idx, n, 100.0::double + 35 * (n % 12) as y0,
  concat(line, case when n % 12 = 2 and n % 7 = 0 then '接上页' when n % 12 = 9 and n % 5 = 0 then '————————' else '' end) as text from lines),
 pg as (select distinct doc_id, page, 595.0::double as height from r),
 five as (select * from (select *, row_number() over (partition by doc_id, page order by block_idx) as k from r where y0 > 40) where k <= 5),
 mk as (select doc_id, page, arg_min(y0, block_idx) - 1 as by_mark from five where contains(text, '接上页') group by all),
 ra as (select doc_id, page, max(y0) - 2 as by_rule from r where n % 12 = 10 and n % 3 = 0 group by all),
 rb as (select doc_id, page, arg_min(y0, block_idx) - 2 as by_rule from r where y0 > 80 and regexp_matches(text, '[—_]{8,}') group by all),
 sp as (select pg.doc_id, pg.page, height, coalesce(ra.by_rule, by_mark, height) as split_a, coalesce(rb.by_rule, by_mark, height) as split_b from pg left join ra using (doc_id, page) left join rb using (doc_id, page) left join mk using (doc_id, page))"""


@query("split_line", _REGIONS + " select doc_id, page, split_a, split_b from sp")
def split_line(spark: SparkSession, sf: str) -> DataFrame:
    a = layout.split_lines(*_regions(spark, sf), PROFILE_A).select("doc_id", "page", F.col("split_y").alias("split_a"))
    b = layout.split_lines(*_regions(spark, sf), PROFILE_B).select("doc_id", "page", F.col("split_y").alias("split_b"))
    return a.join(b, ["doc_id", "page"])


@query("region_route", _REGIONS + " select r.doc_id, r.page, block_idx, case when y0 >= split_a then 'note' else 'body' end as region from r join sp using (doc_id, page) where y0 >= least(110, split_a) and y0 <= least(520, height)")
def region_route(spark: SparkSession, sf: str) -> DataFrame:
    pages, blocks, drawings = _regions(spark, sf)
    return layout.with_region(blocks, layout.split_lines(pages, blocks, drawings, PROFILE_A), PROFILE_A).select("doc_id", "page", "block_idx", "region")


# ---------------------------------------------------------------- notes

_REFS = _SPANS + """, raw as (select doc_id, page, line_idx, string_agg(text, '' order by span_idx) as raw from spans where line_idx < 10 group by all),
c as (select *, cast(len(regexp_extract_all(raw, '[①-⑩]')) as bigint) as n_refs from raw),
n as (select *, cast(coalesce(sum(n_refs) over (partition by doc_id order by page, line_idx rows between unbounded preceding and 1 preceding), 0) as bigint) as refs_before from c),
ids as (select doc_id, page, unnest(generate_series(refs_before + 1, refs_before + n_refs)) as note_id from n where n_refs > 0),
refs as (select *, row_number() over (partition by doc_id, page order by note_id) as k from ids)"""


def _numbered(spark: SparkSession, sf: str) -> DataFrame:
    return layout.reference_counts(X.spark_spans(spark, sf).filter("line_idx < 10"))


@query("note_numbering", _REFS + " select doc_id, page, line_idx, n_refs, refs_before from n")
def note_numbering(spark: SparkSession, sf: str) -> DataFrame:
    return _numbered(spark, sf).select("doc_id", "page", "line_idx", F.col("n_refs").cast("long").alias("n_refs"), "refs_before")


_NOTE_PAIRS = f"""t as (select *, {_strip('raw')} as text from note_lines),
mk as (select *, regexp_matches(text, '^[①-⑩]') as is_mark from t where text <> '' and not regexp_matches(text, '[—_]{{8,}}')),
kk as (select *, case when is_mark then sum(is_mark::int) over (partition by doc_id, page order by ord) end as k from mk),
pn as (select kk.doc_id, kk.page, ord, is_mark, raw, x0, case when is_mark then '[^' || coalesce(cast(note_id as varchar), 'x') || ']: ' || substr(text, 2) else text end as text from kk left join refs on refs.doc_id = kk.doc_id and refs.page = kk.page and refs.k = kk.k)"""
_NOTES = _REFS + ", note_lines as (select " + X.NOTE_SQL + " from lines), " + _NOTE_PAIRS


def _references(spark: SparkSession, sf: str) -> DataFrame:
    """The references of pages; lines without any do not count."""
    return paragraphs.page_references(layout.reference_counts(X.spark_spans(spark, sf).filter(F.col("text").rlike(layout.GLYPH) & (F.col("line_idx") < 10))))


def _paired(spark: SparkSession, sf: str) -> DataFrame:
    return paragraphs.paired_notes(X.spark_notes(spark, sf), _references(spark, sf))


@query("note_pairing", _NOTES + " select doc_id, page, ord, is_mark, text from pn")
def note_pairing(spark: SparkSession, sf: str) -> DataFrame:
    return _paired(spark, sf).select("doc_id", "page", "ord", "is_mark", "text")


def _note_islands(new: str, name: str) -> str:
    w = "over (partition by doc_id order by ord)"
    return f""", {name}0 as (select *, row_number() {w} as rn from pn), {name}1 as (select *, cast(sum(({new} or rn = 1)::int) {w} as bigint) as note from {name}0),
{name} as (select doc_id, note, string_agg(text, '' order by ord) as text from {name}1 group by all)"""


_INDENT_NOTE = "(is_mark or x0 > 75 or starts_with(raw, '　'))"


@query("note_islands", _NOTES + _note_islands("is_mark", "na") + _note_islands(_INDENT_NOTE, "nb") + " select 'a' as profile, * from na union all select 'b', * from nb")
def note_islands(spark: SparkSession, sf: str) -> DataFrame:
    each = [F.struct(F.lit(p.name).alias("profile"), F.lit(float(p.indent)).alias("indent"), F.lit(p.indent_opens_note).alias("indent_opens_note")) for p in (PROFILE_A, PROFILE_B)]
    rows = _paired(spark, sf).withColumn(SETTINGS, F.explode(F.array(*each))).withColumn("profile", F.col(f"{SETTINGS}.profile"))
    return paragraphs.note_islands(rows, BY_BOOK, ("profile",)).select("doc_id", "note", "text", "profile")


# ---------------------------------------------------------------- paragraphs

_SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"


def _para(p: Profile, source: str = X.SQL["paras"]) -> str:
    w = "over (partition by doc_id order by ord"
    heading = f"not coalesce(lag(text like '#%') {w}) and lag(page) {w}) = page, false)" if p.heading_continues else "true"
    bare = "case when not is_new and text like '> %' and lead_text like '> %' then substr(text, 3)"
    if p.heading_continues:
        bare += f" when not is_new and regexp_matches(text, '^#+{_SPACE}') and regexp_matches(lead_text, '^#+{_SPACE}') then regexp_replace(text, '^#+{_SPACE}*', '')"
    seam = lambda a, b: (
        f"coalesce(case when {a} like '%**' and {b} like '**%' then case when length({a}) > 2 and {_cjk(f'left(right({a}, 3), 1)')} and {_cjk(f'substr({b}, 3, 1)')} then 2 else 0 end"
        f" when {a} like '%*' and {b} like '*%' and {a} not like '%**' and {b} not like '**%' and length({a}) > 1 and {_cjk(f'left(right({a}, 2), 1)')} and {_cjk(f'substr({b}, 2, 1)')} then 1 else 0 end, 0)"
    )
    return f"""with {source},
 r as (select * from paras where text <> '' and not regexp_matches(text, '[—_]{{8,}}')),
 b as (select *, text like '> %' as q, row_number() {w}) = 1 as f, case when regexp_matches(text, '^{_SPACE}*\\[\\^[0-9]+\\]') then false when text like '#%' then {heading} else x0 > {p.indent} or starts_with(raw, '　') or starts_with(raw, '  ') end as base from r),
 s as (select *, coalesce(last_value(case when base or q or f then q end ignore nulls) {w} rows between unbounded preceding and 1 preceding), false) as state from b),
 n as (select *, f or base or (q and not state) as is_new from s),
 i as (select *, cast(sum(is_new::int) {w}) as bigint) as island from n),
 l as (select *, first_value(text) over (partition by doc_id, island order by ord) as lead_text from i),
 t as (select *, {bare} else text end as bare from l),
 z as (select *, lag(bare) over v as pv, lead(bare) over v as nx from t window v as (partition by doc_id, island order by ord)),
 k as (select *, {seam('pv', 'bare')} as hd, {seam('bare', 'nx')} as tl from z),
 pc as (select *, case when is_new or hd > 0 or ({_cjk('right(pv, 1)')} and {_cjk('left(bare, 1)')}) then '' else ' ' end as separator, substr(bare, hd + 1, greatest(0, length(bare) - hd - tl)) as piece from k),
 pp as (select doc_id, island, string_agg(separator || piece, '' order by ord) as paragraph from pc group by all),
 qg as (select *, paragraph like '> %' as q from pp),
 qb as (select *, (not (q and coalesce(lag(q) over (partition by doc_id order by island), false)))::int as o from qg),
 qs as (select *, cast(sum(o) over (partition by doc_id order by island) as bigint) as block from qb),
 mq as (select doc_id, block, string_agg(paragraph, chr(10) || '>' || chr(10) order by island) as paragraph from qs group by all)"""


def _pieces(spark: SparkSession, sf: str, p: Profile) -> DataFrame:
    return paragraphs.with_pieces(paragraphs.with_islands(X.spark_paras(spark, sf), p), p)


for _p in (PROFILE_A, PROFILE_B):
    query(f"para_islands_{_p.name}", _para(_p) + " select doc_id, ord, is_new, island from i")(lambda spark, sf, p=_p: paragraphs.with_islands(X.spark_paras(spark, sf), p).select("doc_id", "ord", "is_new", "island"))
    query(f"para_fusion_{_p.name}", _para(_p) + " select doc_id, ord, separator, piece from pc")(lambda spark, sf, p=_p: _pieces(spark, sf, p).select("doc_id", "ord", "separator", "piece"))
    query(f"quote_merge_{_p.name}", _para(_p) + " select doc_id, block, paragraph from mq")(lambda spark, sf, p=_p: paragraphs.merged_quotes(paragraphs.paragraphs(_pieces(spark, sf, p))))


@query("article_markdown", "select doc_id, concat_ws(chr(10) || chr(10), body, notes) as markdown from (select doc_id, string_agg(paragraph, chr(10) || chr(10) order by block) as body from (" + _para(PROFILE_A) + " select * from mq) group by doc_id) full join (select doc_id, string_agg(text, chr(10) || chr(10) order by note) as notes from (" + _NOTES + _note_islands("is_mark", "na") + " select * from na) group by doc_id) using (doc_id)")
def article_markdown(spark: SparkSession, sf: str) -> DataFrame:
    blocks = paragraphs.merged_quotes(paragraphs.paragraphs(_pieces(spark, sf, PROFILE_A)))
    return paragraphs.articles(blocks, paragraphs.note_islands(_paired(spark, sf), PROFILE_A))


@query("article_stream", "select cast(doc_id as varchar) as doc_id, markdown from (" + ORACLES["article_markdown"] + ")")
def article_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same articles from a stream of their pages, with the open paragraphs and notes in the state store."""
    folder = own_folder(spark, "article-stream")
    articles.page_rows(X.spark_page_lines(spark, sf, layout.GLYPH)).write.option("compression", "zstd").parquet(f"{folder}/pages")
    return articles.streamed(spark, f"{folder}/pages", folder)


# Lines of the regions with their text.  Of a line's spans only one has a reference, and in profile A headings are never cut.
_LAYOUT = (
    "with " + X.SQL["spans"] + _REGIONS.removeprefix("with " + X.SQL["lines"]) + _LINES.removeprefix(_SPANS)
    + f""",
 kl as (select p.*, page * 12 + line_idx as ord, case when y0 >= split_a then 'note' else 'body' end as region from p join sp using (doc_id, page) where y0 >= least(110, split_a) and y0 <= least(520, height)),
 nb0 as (select *, cast(len(regexp_extract_all(raw, '[①-⑩]')) as bigint) as n_refs from kl where region = 'body'),
 nb as (select *, cast(coalesce(sum(n_refs) over (partition by doc_id order by page, line_idx rows between unbounded preceding and 1 preceding), 0) as bigint) as refs_before from nb0),
 ts0 as (select doc_id, page, line_idx, span_idx, prefix, refs_before, {_without_marks('s.text')} as shown, case when {_BOLD} and {_ITALIC} then '***' when {_BOLD} then '**' when {_ITALIC} then '*' else '' end as mark from spans s join nb using (doc_id, page, line_idx)),
 ts as (select * exclude (shown), regexp_replace(shown, '[①-⑩]', '[^' || (refs_before + 1) || ']') as text from ts0 where shown <> ''),
 bt as (select doc_id, page, line_idx, any_value(prefix) as prefix, {_strip("string_agg(case when starts_with(prefix, '#') or mark = '' then text else " + _STYLED + " end, '' order by span_idx)")} as body from ts group by all),
 lt as (select nb.doc_id, nb.page, nb.ord, raw, x0, case when body = '' then '' when starts_with(bt.prefix, '#') then bt.prefix || {_normalized('body')} when bt.prefix = '> ' then '> ' || body else body end as text from nb join bt using (doc_id, page, line_idx))"""
)
_LAYOUT_PARAS = f"paras as ({_LAYOUT} select doc_id, page, cast(ord as bigint) as ord, text, raw, x0 from lt)"
_LAYOUT_NOTES = (
    f"with note_lines as ({_LAYOUT} select doc_id, page, cast(ord as bigint) as ord, raw, x0 from kl where region = 'note'), refs as ({_LAYOUT}, ids as (select doc_id, page, unnest(generate_series(refs_before + 1, refs_before + n_refs)) as note_id from nb where n_refs > 0)"
    " select *, row_number() over (partition by doc_id, page order by note_id) as k from ids), " + _NOTE_PAIRS
)


def _article_sql(p: Profile) -> str:
    """Articles of the layout in a profile; the parts above are those of profile A."""
    paras, notes, new = _LAYOUT_PARAS, _LAYOUT_NOTES, "is_mark"
    if p is PROFILE_B:
        for a, b in ((_nearest_case("max_size", PROFILE_A), _nearest_case("max_size", PROFILE_B)), ("y0 >= split_a then", "y0 >= split_b then"), ("y0 >= least(110, split_a) and y0 <= least(520, height)", "y0 >= least(80, split_b) and y0 <= height")):
            assert a in paras and a in notes
            paras, notes = paras.replace(a, b), notes.replace(a, b)
        new = _INDENT_NOTE
    body = "select doc_id, string_agg(paragraph, chr(10) || chr(10) order by block) as body from (" + _para(p, paras) + " select * from mq) group by doc_id"
    foot = "select doc_id, string_agg(text, chr(10) || chr(10) order by note) as notes from (" + notes + _note_islands(new, "na") + " select * from na) group by doc_id"
    return f"select doc_id, concat_ws(chr(10) || chr(10), body, notes) as markdown from ({body}) full join ({foot}) using (doc_id)"


def _laid_out(spark: SparkSession, sf: str, p: Settings, with_own=lambda rows: rows) -> DataFrame:
    pages, blocks, drawings = _regions(spark, sf)
    # Lines are kept once: body, notes and references are all made of them.
    splits = layout.split_lines(with_own(pages), with_own(blocks), drawings, p)
    rows = layout.with_region(with_own(layout.lines(X.spark_spans(spark, sf, dealt=True))), splits, p)
    rows = written(rows, "laid-out").withColumn("ord", F.col("page").cast("long") * 12 + F.col("line_idx"))
    raw = F.array_join(F.transform("spans", lambda s: s["text"]), "")
    body = layout.with_references(layout.with_prefix(layout.with_features(rows.filter("region = 'body'"), p), p))
    lines = layout.with_text(body, p).withColumn("raw", raw)
    blocks = paragraphs.merged_quotes(paragraphs.paragraphs(paragraphs.with_pieces(paragraphs.with_islands(lines, p), p)))
    own = [c for c in rows.columns if c == SETTINGS]
    foot = rows.filter("region = 'note'").select("doc_id", "page", "ord", raw.alias("raw"), "x0", *own)
    notes = paragraphs.note_islands(paragraphs.paired_notes(foot, paragraphs.page_references(body)), p)
    return paragraphs.articles(blocks, notes)


@query("layout_markdown", _article_sql(PROFILE_A))
def layout_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """From spans to articles: regions, classification, styles, references, paragraphs and notes in one plan."""
    return _laid_out(spark, sf, PROFILE_A)


@query("layout_by_book", f"select * from ({_article_sql(PROFILE_A)}) where doc_id % 2 = 0 union all select * from ({_article_sql(PROFILE_B)}) where doc_id % 2 = 1")
def layout_by_book(spark: SparkSession, sf: str) -> DataFrame:
    """The same in one plan over books of both profiles, whose settings are data."""
    of = X.read(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b").alias("profile"))
    return _laid_out(spark, sf, BY_BOOK, lambda rows: with_settings(rows, of))


# ---------------------------------------------------------------- probes

@query("font_histogram", _SPANS + f", s as (select *, {_strip('text')} as bare from spans where page % 20 = 0), g as (select round(size, 1) as size, count(*) as n, first(bare order by length(bare) desc, doc_id, page, line_idx, span_idx) as example from s where bare <> '' group by 1) select *, case when n = (select max(n) from g) then 'body' when size < 10 then 'note' when n < 1000 then 'heading' else '' end as guess from g")
def font_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.size_histogram(X.spark_spans(spark, sf))


@query("spans_by_size", _SPANS + ", g as (select doc_id, page, line_idx, string_agg(text, '' order by span_idx) as whole, string_agg(distinct case when abs(size - 7.4) <= 0.5 then font end, ', ' order by case when abs(size - 7.4) <= 0.5 then font end) as fonts, bool_or(abs(size - 7.4) <= 0.5) as hit from spans group by all) select doc_id, page, line_idx, case when length(whole) > 80 then substr(whole, 1, 80) || '…' else whole end as line, fonts from g where hit")
def spans_by_size(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.lines_with_size(X.spark_spans(spark, sf), 7.4)


@query("keyword_blocks", _SPANS + " select doc_id, page, line_idx, span_idx, contains(text, '①') as has_keyword from spans s where exists (select 1 from spans k where k.doc_id = s.doc_id and k.page = s.page and contains(k.text, '①'))")
def keyword_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.keyword_spans(X.spark_spans(spark, sf), "①").select("doc_id", "page", "line_idx", "span_idx", "has_keyword")


_HISTOGRAM = ORACLES["font_histogram"]


@query("size_report", f"select *, cast(row_number() over (order by size desc) as int) as place from ({_HISTOGRAM})")
def size_report(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.by_size(profiling.size_histogram(X.spark_spans(spark, sf)))


@query("result_counts", f"select doc_id, count(*) as n from ({ORACLES['spans_by_size']}) group by doc_id")
def result_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.counted(profiling.lines_with_size(X.spark_spans(spark, sf), 7.4))


@query("block_keywords", _REGIONS + " select doc_id, page, block_idx, text from r where contains(text, '接上页')")
def block_keywords(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.keyword_blocks(_regions(spark, sf)[1], "接上页").select("doc_id", "page", "block_idx", "text")


@query("divider_probe", _REGIONS + " select r.doc_id, r.page, r.y0, 'rule' as kind from r join pg using (doc_id, page) where n % 12 = 10 and n % 3 = 0 and r.y0 > height * 0.6 union all select doc_id, page, y0, 'text' from r where contains(text, '____') or contains(text, '————')")
def divider_probe(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.divider_candidates(*_regions(spark, sf))


_LISTED = [1, 2, 3, 5, 52, 88, 9999]


@query("page_list", _REGIONS + f", d as (select doc_id, cast(doc_id % 7 as int) as n_pages from documents) select doc_id, page from pg join d using (doc_id) where page + 1 in ({', '.join(map(str, _LISTED))}) and page + 1 <= n_pages")
def page_list(spark: SparkSession, sf: str) -> DataFrame:
    docs = X.read(spark, sf, "documents").select("doc_id", (F.col("doc_id") % 7).cast("int").alias("n_pages"))
    return profiling.listed_pages(_regions(spark, sf)[0], _LISTED, docs).select("doc_id", "page")


@query("prefix_guess", _SPANS + f", g as (select doc_id, page, line_idx, min(x0) as x0, bool_or(regexp_matches(lower(font), 'hei|bold')) as has_heiti, string_agg(text, '' order by span_idx) as whole from spans group by all) select doc_id, page, line_idx, has_heiti, case when not has_heiti then 'not bold' when x0 >= 150 then '### ' when x0 >= 120 then '> ' when x0 > 105 then '> ?' else 'body' end as guess from g where {_strip('whole')} <> ''")
def prefix_guess(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.guessed_prefixes(layout.lines(X.spark_spans(spark, sf))).select("doc_id", "page", "line_idx", "has_heiti", "guess")


@query("page_split", "with c as (select o_custkey as doc_id, cast(o_orderkey % 97 as int) as page from orders), d as (select c_custkey as doc_id, 60 as n_pages from customer), i as (select distinct c.doc_id, page - 1 as lo from c join d using (doc_id) where page - 1 > 0 and page - 1 < n_pages), b as (select * from i union all select doc_id, 0 from d), r as (select doc_id, lo, row_number() over (partition by doc_id order by lo) as part, lead(lo) over (partition by doc_id order by lo) as hi from b) select r.doc_id, cast(part as int) as part, lo, coalesce(hi, n_pages) as hi, 'part' || part || '_p' || (lo + 1) || '-p' || coalesce(hi, n_pages) as name from r join d using (doc_id) where lo < coalesce(hi, n_pages)")
def page_split(spark: SparkSession, sf: str) -> DataFrame:
    cuts = X.read(spark, sf, "orders").select(F.col("o_custkey").alias("doc_id"), (F.col("o_orderkey") % 97).cast("int").alias("page"))
    return profiling.parts(cuts, X.read(spark, sf, "customer").select(F.col("c_custkey").alias("doc_id"), F.lit(60).alias("n_pages")))


_PARTS = _REGIONS + """, c as (select o_custkey as doc_id, cast(o_orderkey % 9 as int) as page from orders), d as (select doc_id, max(page) + 1 as n_pages from pg group by doc_id),
 i as (select distinct c.doc_id, page - 1 as lo from c join d using (doc_id) where page - 1 > 0 and page - 1 < n_pages), b as (select * from i union all select doc_id, 0 from d),
 o as (select doc_id, lo, cast(row_number() over (partition by doc_id order by lo) as int) as part, lead(lo) over (partition by doc_id order by lo) as hi from b)
 select doc_id, pg.page, part, 'd' || doc_id || '_part' || part || '_p' || (lo + 1) || '-p' || coalesce(hi, n_pages) as name from pg join d using (doc_id) join o using (doc_id) where pg.page >= lo and pg.page < coalesce(hi, n_pages)"""


@query("page_parts", _PARTS)
def page_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The documents' pages with the part that they go to, as the sink writes them."""
    pages = _regions(spark, sf)[0].select("doc_id", "page")
    cuts = X.read(spark, sf, "orders").select(F.col("o_custkey").alias("doc_id"), (F.col("o_orderkey") % 9).cast("int").alias("page"))
    docs = pages.groupBy("doc_id").agg((F.max("page") + 1).alias("n_pages")).withColumn("stem", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    return profiling.split_pages(pages, cuts, docs)


# ---------------------------------------------------------------- web pages and e-books

# RE2 has no back-references: the two elements are removed one after the other.
_NO_SCRIPT = "regexp_replace(regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script\\s*>', '', 'g'), '(?is)<style\\b[^>]*>.*?</style\\s*>', '', 'g')"


@query("html_strip_scripts", f"select page_id, {_NO_SCRIPT} as html from pages")
def html_strip_scripts(spark: SparkSession, sf: str) -> DataFrame:
    return X.read(spark, sf, "pages").select("page_id", html.without_scripts("html").alias("html"))


@query("html_headings", f"with h as (select page_id, unnest(regexp_extract_all({_NO_SCRIPT}, '(?is)<h1\\b[^>]*>.*?</h1\\s*>')) as h, generate_subscripts(regexp_extract_all({_NO_SCRIPT}, '(?is)<h1\\b[^>]*>.*?</h1\\s*>'), 1) - 1 as n from pages) select page_id, cast(n as int) as n, 1 as level, trim(regexp_replace(regexp_replace(h, '(?s)<[^>]*>', '', 'g'), '\\s+', ' ', 'g')) as title from h")
def html_headings(spark: SparkSession, sf: str) -> DataFrame:
    return html.headings(X.read(spark, sf, "pages"))


_A = "'(?is)<a\\s[^>]*?href=\"([^\"]*)\"'"


@query("html_links", f"select page_id, cast(generate_subscripts(regexp_extract_all({_NO_SCRIPT}, {_A}, 1), 1) - 1 as int) as n, unnest(regexp_extract_all({_NO_SCRIPT}, {_A}, 1)) as href from pages")
def html_links(spark: SparkSession, sf: str) -> DataFrame:
    return html.links(X.read(spark, sf, "pages"))


@query("html_to_markdown")
def html_to_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as Markdown, then reflowed in windows."""
    pages = html.markdown_pages(X.read(spark, sf, "pages")).select("page_id", F.posexplode(F.split("markdown", "\n")).alias("n", "line"))
    return reflow.reflowed(pages, key="page_id")


_SRC = "case page_id % 4 when 0 then './images/' || page_id || '.png' when 1 then '../' || page_id || '.png' when 2 then 'https://x/y.png' else '..\\..\\../' || page_id || '.png' end"
_RESOLVED = "array_to_string(list_reduce(list_transform(string_split(replace(regexp_replace('{base}', '[^/]*$', '') || src, '\\', '/'), '/'), lambda p: [p]), lambda a, p: case when p[1] in ('', '.') then a when p[1] = '..' then a[1 : len(a) - 1] else a || p end, []::varchar[]), '/')"


@query("href_resolve", f"select page_id, case when src = '' or regexp_matches(src, '^(data:|https?://)') then src else {_RESOLVED.format(base='OEBPS/text/c.xhtml')} end as path from (select page_id, {_SRC} as src from pages)")
def href_resolve(spark: SparkSession, sf: str) -> DataFrame:
    k, name = F.col("page_id") % 4, F.concat("page_id", F.lit(".png"))
    src = F.when(k == 0, F.concat(F.lit("./images/"), name)).when(k == 1, F.concat(F.lit("../"), name)).when(k == 2, "https://x/y.png").otherwise(F.concat(F.lit("..\\..\\../"), name))
    return X.read(spark, sf, "pages").select("page_id", T.resolved_path(F.lit("OEBPS/text/c.xhtml"), src).alias("path"))


_FORMS = "[(0, path), (1, regexp_replace(path, '^\\./', '')), (2, regexp_replace(path, '^/+', '')), (3, 'OEBPS/' || path), (4, replace(path, '\\', '/'))]"


@query("href_fallback", f"with items as (select 'OEBPS/img' || page_id || '.gif' as href, page_id % 3 <> 2 as filled from pages), images as (select page_id, case when page_id % 3 = 0 then './img' else 'OEBPS/img' end || page_id || '.gif' as src from pages), local as (select page_id, {_RESOLVED.format(base='text.xhtml')} as path from images), forms as (select page_id, unnest({_FORMS}) as f from local) select page_id, arg_min(href, f[1]) as href from forms join items on href = f[2] where filled group by page_id")
def href_fallback(spark: SparkSession, sf: str) -> DataFrame:
    from quire.sources.epub import matched_images

    pages = X.read(spark, sf, "pages").withColumn("doc_id", F.lit("book"))
    items = pages.select("doc_id", F.concat(F.lit("OEBPS/img"), "page_id", F.lit(".gif")).alias("href"), F.when(F.col("page_id") % 3 != 2, F.unhex(F.lit("474946383961"))).alias("content"))
    images = pages.select("doc_id", F.lit("text.xhtml").alias("base"), F.lit(0).alias("n"), "page_id", F.concat(F.when(F.col("page_id") % 3 == 0, "./img").otherwise("OEBPS/img"), "page_id", F.lit(".gif")).alias("src"))
    return matched_images(images.withColumn("n", F.col("page_id")), items).select(F.col("n").alias("page_id"), "href")


_NAME = "lower(case page_id % 5 when 0 then 'p.JPEG' when 3 then 'x.webp' else 'p' end)"
_MAGIC = "case page_id % 5 when 1 then '474946383961' when 4 then 'FFD8FFE0' else '00' end"


@query("image_ext", f"select page_id, case when contains(h, 'png') then '.png' when contains(h, 'jpg') or contains(h, 'jpeg') then '.jpg' when contains(h, 'gif') then '.gif' when contains(h, 'webp') then '.webp' when starts_with(m, '89504E470D0A1A0A') then '.png' when starts_with(m, 'FFD8') then '.jpg' when starts_with(m, '474946383961') or starts_with(m, '474946383761') then '.gif' else '.png' end as ext from (select page_id, {_NAME} as h, {_MAGIC} as m from pages)")
def image_ext(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("page_id") % 5
    name = F.when(k == 0, "p.JPEG").when(k == 3, "x.webp").otherwise("p")
    content = F.when(k == 1, F.unhex(F.lit("474946383961"))).when(k == 4, F.unhex(F.lit("FFD8FFE0"))).otherwise(F.unhex(F.lit("00")))
    return X.read(spark, sf, "pages").select("page_id", T.image_extension(name, content).alias("ext"))


_BOOKS = """with pg as (select page_id, url, page_id % 20 as b, cast(row_number() over (partition by page_id % 20 order by page_id) as int) as ord from pages),
 sp as (select b, 'Book ' || b as book, ord, 'OEBPS/text/' || page_id || '.xhtml' as href, case when page_id % 5 = 0 then cast(page_id as varchar) else 'Page ' || page_id end as title, case when page_id % 5 = 0 then 'Book ' || b else 'Part_ ' || (page_id % 2) end as category, page_id, url from pg)"""


@query("epub_spine", _BOOKS + " select book, ord as \"order\", href, title, category from sp")
def epub_spine(spark: SparkSession, sf: str) -> DataFrame:
    """Spine documents of e-books that are made of the pages, with titles and categories from their navigation."""
    rows = written(epub.members_of(X.spark_books(spark, sf)), "epub")  # each book is made and unpacked once
    docs = epub.spine_documents(*epub.parts(rows))
    return docs.select("book", "order", "href", "title", "category")


@query("epub_bundles", _BOOKS + " select book || '/' || category || '/' || title || '/index.md' as rel_path, '---' || chr(10) || 'book: ' || book || chr(10) || 'category: ' || category || chr(10) || 'order: ' || ord || chr(10) || 'title: ' || case when page_id % 5 = 0 then chr(39) || title || chr(39) else title end || chr(10) || '---' || chr(10) || chr(10) || '# ' || page_id || chr(10) || chr(10) || url || case when page_id % 4 = 0 then chr(10) || chr(10) || '![img](assets/img_1.png)' else '' end as markdown from sp")
def epub_bundles(spark: SparkSession, sf: str) -> DataFrame:
    return books.bundles_of(epub.members_of(X.spark_books(spark, sf)))[0].select("rel_path", "markdown")


@query("epub_images", _BOOKS + " select book || '/' || category || '/' || title || '/assets/img_1.png' as rel_path, '89504E470D0A1A0A' as content from sp where page_id % 4 = 0")
def epub_images(spark: SparkSession, sf: str) -> DataFrame:
    return books.bundles_of(epub.members_of(X.spark_books(spark, sf)))[1].select("rel_path", F.hex("content").alias("content"))


@query("conversation_markdown", "select conv_id, '# ' || conv_id || chr(10) || chr(10) || string_agg('## ' || role || chr(10) || chr(10) || coalesce(text, ''), chr(10) || chr(10) order by turn) as markdown from conversations group by conv_id")
def conversation_markdown(spark: SparkSession, sf: str) -> DataFrame:
    turns = X.read(spark, sf, "conversations")
    section = F.concat(F.lit("## "), "role", F.lit("\n\n"), F.coalesce("text", F.lit("")))
    return turns.groupBy("conv_id").agg(reflow.joined(F.col("turn"), section, "\n\n").alias("_body")).select("conv_id", F.concat(F.lit("# "), F.col("conv_id").cast("string"), F.lit("\n\n"), "_body").alias("markdown"))
