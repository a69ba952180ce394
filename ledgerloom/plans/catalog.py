"""Named queries over the test tables, each with independent SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dictionary as D
from ..functions import text as T
from ..functions import values as V
from ..operators import candidates as C
from ..operators import experiment as E
from ..functions import extract as X
from ..operators import fintable, generate, integrity, layout, lines, quality, report, resolve
from ..sources import sinks
from ..sources import tables as S
from ..sources.shared import cut, shared_dir
from ..streaming import streams

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
AS_OF = "2025-06-30"


def query(sql: str | None = None):
    def put(fn):
        QUERIES[fn.__name__] = (fn, sql)
        return fn

    return put


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def n_(x: str) -> str:
    """SQL of text.norm."""
    return f"trim(regexp_replace(replace(lower(translate(regexp_replace(coalesce({x},''),'\\p{{Mn}}','','g'),{lit(T.PLAIN_FROM)},{lit(T.PLAIN_TO)})),'@',' @ '),'[^a-z0-9@]+',' ','g'))"


def squash_(x: str) -> str:
    return f"regexp_replace(lower(trim(coalesce({x},''))),'\\s+',' ','g')"


EL = "el as (select * from raw_artifacts qualify row_number() over (partition by artifact_id order by loaded_at desc)=1)"
CA = "ca as (select * from candidates qualify row_number() over (partition by cand_id order by loaded_at desc)=1)"
def ascii_(x: str) -> str:
    """SQL: letters beyond ASCII as underscores, so that a word boundary is where Unicode has it."""
    return f"regexp_replace({x},'[\\x{{AA}}\\x{{B5}}\\x{{BA}}\\x{{C0}}-\\x{{D6}}\\x{{D8}}-\\x{{F6}}\\x{{F8}}-\\x{{36F}}\\x{{370}}-\\x{{52F}}\\x{{4E00}}-\\x{{9FFF}}\\x{{FF10}}-\\x{{FF19}}\\x{{FF21}}-\\x{{FF3A}}\\x{{FF41}}-\\x{{FF5A}}]','_','g')"


SPACE = r"[\s\p{Z}\x{85}]"
NOT_BLANK = r"[^\s\p{Z}\x{85}]"
LINES = rf"""{EL},
w as (select *, coalesce(page_number,1) p, case when block_num is not null and line_num is not null then block_num end b,
  case when block_num is not null and line_num is not null then line_num else cast(round_even(coalesce(bounding_box.y,0)/12,0) as int) end l,
  trim(regexp_replace(text,'^{SPACE}+|{SPACE}+$','','g')) t, coalesce(bounding_box.x,0) x, coalesce(bounding_box.y,0) y
  from el where regexp_matches(text,'[^\s\p{{Z}}\x{{85}}]')),
g as (select document_id, engine_id, p, b, l, string_agg(t,' ' order by x, ordinal, t) text, count(*) n_words, min(y) top, min(x) lft, min(ordinal) ord from w group by all),
li as (select document_id, engine_id, cast(row_number() over (partition by document_id, engine_id order by p, top, lft, ord, b nulls first, l nulls first)-1 as int) line_index, p page_number, text, cast(n_words as int) n_words from g)"""


def element_lines(s: SparkSession, sf: str) -> DataFrame:
    return lines.build_lines(S.elements(s, sf, *lines.COLUMNS))


# ---- sources -----------------------------------------------------------------------------------


@query("""select distinct document_id, coalesce(nullif(trim(media_type),''), case lower(nullif(regexp_extract(file_name,'\\.([A-Za-z0-9]+)$',1),''))
  when 'pdf' then 'application/pdf' when 'png' then 'image/png' when 'jpg' then 'image/jpeg' when 'jpeg' then 'image/jpeg' when 'tif' then 'image/tiff' when 'tiff' then 'image/tiff' end) media_type from source_documents""")
def document_media_type(s, sf):
    return S.table(s, sf, "source_documents").select("document_id", S.media_type(F.col("media_type"), F.col("file_name")).alias("media_type")).distinct()


@query("""with h as (select distinct source_uri, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(source_uri)) x from source_documents where source_uri is not null)
select source_uri, substr(x,1,8)||'-'||substr(x,9,4)||'-5'||substr(x,14,3)||'-'||substr('89ab', 1 + (strpos('0123456789abcdef', substr(x,17,1))-1)%4, 1)||substr(x,18,3)||'-'||substr(x,21,12) id from h""")
def uuid5_document_id(s, sf):
    d = S.table(s, sf, "source_documents").filter("source_uri is not null").select("source_uri").distinct()
    return d.select("source_uri", V.uuid5(F.col("source_uri")).alias("id"))


@query(r"""select distinct source_uri, case when lower(regexp_extract(source_uri,'^([A-Za-z][A-Za-z0-9+.-]*):',1))='file' then url_decode(regexp_replace(source_uri,'^[Ff][Ii][Ll][Ee]://(?:localhost)?',''))
  when regexp_extract(source_uri,'^([A-Za-z][A-Za-z0-9+.-]*):',1)='' then source_uri end path from source_documents where source_uri is not null""")
def uri_path(s, sf):
    return S.table(s, sf, "source_documents").filter("source_uri is not null").select("source_uri", S.uri_path(F.col("source_uri")).alias("path")).distinct()


@query(f"""with {EL}, k as (select document_id, engine_id, coalesce(page_number,-1) page, text, confidence, bounding_box b, row_number() over (partition by document_id, engine_id, page_number order by ordinal, artifact_id)-1 i from el where document_id is not null)
select document_id, engine_id, page, cast(i as int) as ordinal, trim(text) as text, round(confidence,6) confidence, case when b.x is not null and b.y is not null and b.w is not null and b.h is not null then round(b.x+b.y+b.w+b.h,4) end box from k where regexp_matches(text,'{NOT_BLANK}')""")
def ocr_columns_to_rows(s, sf):
    e = S.elements(s, sf, "document_id", "engine_id", "page_number", "ordinal", "text", "confidence", "bounding_box").filter("document_id is not null")
    # pages as an engine delivers them: one array a column; blanks keep their number
    pack = F.array_sort(F.collect_list(F.struct("ordinal", "artifact_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("confidence") * 100, F.lit(-1.0)).alias("conf"), "bounding_box")))
    pages = e.groupBy("document_id", "engine_id", F.coalesce("page_number", F.lit(-1)).alias("page_number")).agg(pack.alias("w"))
    b = lambda k: F.transform("w", lambda x: x["bounding_box"][k])
    cols = pages.select(F.concat_ws("|", "document_id", "engine_id").alias("document_id"), "page_number", F.transform("w", lambda x: x["text"]).alias("text"), F.transform("w", lambda x: x["conf"]).alias("conf"), b("x").alias("left"), b("y").alias("top"), b("w").alias("width"), b("h").alias("height"))
    k = F.split("document_id", r"\|")
    box = F.round(F.col("bounding_box.x") + F.col("bounding_box.y") + F.col("bounding_box.w") + F.col("bounding_box.h"), 4)
    return S.column_pages(cols).select(k[0].alias("document_id"), k[1].alias("engine_id"), F.col("page_number").alias("page"), "ordinal", "text", F.round("confidence", 6).alias("confidence"), box.alias("box"))


@query(f"with {EL} select artifact_id, text, round(confidence,6) confidence, page_number, coalesce(nullif(element_type,''),'text') element_type, case when bounding_box.x is not null and bounding_box.y is not null and bounding_box.w is not null and bounding_box.h is not null then round(bounding_box.x+bounding_box.y+bounding_box.w+bounding_box.h,4) end box from el")
def json_key_aliases(s, sf):
    e = S.elements(s, sf, "text", "confidence", "page_number", "element_type", "bounding_box")
    odd = F.pmod("artifact_id", F.lit(3))
    b = F.array(*[F.col(f"bounding_box.{k}") for k in "xywh"])
    b = F.when(F.forall(b, lambda x: x.isNotNull()), b)
    payload = (
        F.when(odd == 0, F.to_json(F.struct("text", "confidence", "page_number", F.col("element_type").alias("type"), b.alias("bbox"))))
        .when(odd == 1, F.to_json(F.struct(F.col("text").alias("content"), (F.col("confidence") * 1).alias("score"), F.col("page_number").alias("page"), F.col("element_type").alias("label"), b.alias("box"))))
        .otherwise(F.to_json(F.struct(F.col("text").alias("raw_text"), F.col("confidence").alias("probability"), F.col("page_number").alias("page_num"), "element_type", b.alias("bounding_box"))))
    )
    r = S.json_elements(e.select("artifact_id", payload.alias("payload")))
    box = F.round(F.col("bounding_box.x") + F.col("bounding_box.y") + F.col("bounding_box.w") + F.col("bounding_box.h"), 4)
    return r.withColumn("confidence", F.round("confidence", 6)).withColumn("box", box).drop("bounding_box")


@query(f"with {CA} select document_id, field_name, max_by(value, (candidate_ordinal, cand_id)) as value from ca where value is not null group by all")
def last_wins_field_map(s, sf):
    c = S.candidates(s, sf, "document_id", "field_name", "value", "candidate_ordinal").filter("value is not null")
    return S.last_wins(c, ["document_id", "field_name"], "value", ["candidate_ordinal", "cand_id"])


@query("select distinct document_id from source_documents where document_id is not null and document_id not in (select document_id from raw_artifacts where document_id is not null and engine_id='dolphin')")
def cache_misses(s, sf):
    return S.cache_misses(S.table(s, sf, "source_documents").select("document_id").distinct(), S.table(s, sf, "raw_artifacts").filter("engine_id = 'dolphin'"))


@query(r"select distinct file_name, coalesce(nullif(regexp_replace(file_name,'[^\p{L}\p{N}_-]','_','g'),''),'document') as safe from source_documents")
def safe_name(s, sf):
    return S.table(s, sf, "source_documents").select("file_name", T.safe_name(F.col("file_name")).alias("safe")).distinct()


@query(f"with {CA} select document_id, engine_id, '{{\"candidates\":'||count(*)||',\"fields\":'||count(distinct field_name)||'}}' as summary from ca group by all")
def bundle_summary(s, sf):
    g = S.candidates(s, sf, "document_id", "engine_id", "field_name").groupBy("document_id", "engine_id").agg(F.count("*").alias("candidates"), F.countDistinct("field_name").alias("fields"))
    return g.select("document_id", "engine_id", sinks.sorted_json(g, ["candidates", "fields"]).alias("summary"))


# ---- elements, lines, layout -------------------------------------------------------------------


@query(rf"with {EL} select artifact_id, engine_id from el where regexp_matches(text,'[^\s\p{{Z}}\x{{85}}]')")
def element_blank_filter(s, sf):
    e = S.table(s, sf, "raw_artifacts").select("artifact_id", "loaded_at", "engine_id", T.is_blank(F.col("text")).alias("blank"))
    return S.latest(e, "artifact_id").filter("not blank").select("artifact_id", "engine_id")


@query(f"with {EL} select artifact_id, coalesce(nullif(source_engine,''),'unknown') as source_engine, element_type as source_element_type, text as raw_text, block_num as block_hint, line_num as line_hint, word_num as word_hint, nullif(trim(raw_label),'') as label_hint from el")
def raw_artifact_projection(s, sf):
    e = S.elements(s, sf, "source_engine", "element_type", "text", "block_num", "line_num", "word_num", "raw_label")
    hints = e.withColumns({c: F.col(c).cast("string") for c in ("block_num", "line_num", "word_num")})  # as engines deliver them
    return lines.normalized(hints, "artifact_id").drop("trace")


@query(f"with {LINES} select document_id, engine_id, line_index, page_number, text, n_words from li")
def line_build(s, sf):
    return element_lines(s, sf).select("document_id", "engine_id", "line_index", "page_number", "text", "n_words")


def _score_sql(section: str) -> str:
    parts = [f"case when contains(' '||n||' ', {lit(' ' + p + ' ')}) then {k} else 0 end" for p, k in D.PHRASES[section].items()]
    if section == "ignored_billing":
        parts.append("case when length(replace(n,' ',''))>0 and length(regexp_replace(n,'[^0-9]','','g'))/length(replace(n,' ',''))>0.55 and (contains(n,'vencimento') or contains(n,'documento') or contains(n,'pagamento')) then 3 else 0 end")
    return "+".join(parts) + f" as s_{section}"


_SECTION_SQL = ", ".join(_score_sql(x) for x in lines.SECTIONS)
_BEST = "greatest(" + ",".join(f"s_{x}" for x in lines.SECTIONS) + ")"
_PICK = f"case when {_BEST}=0 then 'header' " + " ".join(f"when s_{x}={_BEST} then '{x}'" for x in lines.SECTIONS) + " end"


@query(f"with {LINES}, t as (select *, {n_('text')} n from li), sc as (select document_id, engine_id, line_index, {_SECTION_SQL} from t) select document_id, engine_id, line_index, {_PICK} as section_explicit, cast({_BEST} as int) as section_score from sc")
def line_section_score(s, sf):
    return lines.score_sections(element_lines(s, sf)).select("document_id", "engine_id", "line_index", "section_explicit", "section_score")


_RULES = [
    ("ex='ignored_billing' and sv>=3", "'ignored_billing'", 0.95), ("ex in ('provider','recipient','service','values') and sv>=3", "ex", 0.92), ("cur='ignored_billing' and ex not in ('header','provider','recipient','service')", "'ignored_billing'", 0.75),
    ("p and cur in ('provider','recipient')", "cur", 0.78), ("p and cur='header' and not r and not s and not mun", "'provider'", 0.72), ("svc and cur='service'", "'service'", 0.72), ("val and cur in ('service','values')", "'values'", 0.72),
    ("ex='header' and sv>=2", "'header'", 0.85), ("sv>0 and ex in ('provider','recipient','service','values')", "ex", 0.62),
]
_STEP = "case " + " ".join(f"when {c} then {x}" for c, x, _ in _RULES) + " when cur='ignored_billing' then 'header' else cur end"
_CONF = "cast(case " + " ".join(f"when {c} then {k}" for c, _, k in _RULES) + " else 0.55 end as double)"


def _any_sql(words: list[str]) -> str:
    return "(" + " or ".join(f"contains(' '||n||' ',' {w} ')" for w in words) + ")"


_FOLD = f"""with recursive {LINES}, t as (select document_id, engine_id, line_index, {n_('text')} n from li), sc as (select *, {_SECTION_SQL} from t),
ft as materialized (select document_id, engine_id, line_index, {_PICK} as ex, cast({_BEST} as int) as sv, {_any_sql(D.PARTY_DETAIL)} p, {_any_sql(D.SERVICE_DETAIL)} svc, {_any_sql(D.VALUE_DETAIL)} val, contains(n,'prefeitura') or contains(n,'secretaria') or starts_with(n,'municipio de ') mun from sc),
st as (select document_id, engine_id, line_index, ex, sv, p, svc, val, mun, 'header' cur, false r, false s from ft where line_index=0
 union all select f.document_id, f.engine_id, f.line_index, f.ex, f.sv, f.p, f.svc, f.val, f.mun, g.sec, g.r or g.sec='recipient', g.s or g.sec='service' from (select *, {{step}} sec from st) g join ft f on f.document_id is not distinct from g.document_id and f.engine_id is not distinct from g.engine_id and f.line_index=g.line_index+1)""".replace("{step}", _STEP)


@query(_FOLD + f" select document_id, engine_id, line_index, ex as section_explicit, sv as section_score, {_STEP} as section, {_CONF} as section_confidence from st")
def line_section_fold(s, sf):
    return lines.classify_sections(element_lines(s, sf)).select("document_id", "engine_id", "line_index", "section_explicit", "section_score", "section", "section_confidence")


@query(f"""with {LINES}, m as (select document_id, engine_id, line_index, case when starts_with({n_('text')},'prestador') then 'provider' when starts_with({n_('text')},'tomador') then 'recipient' end k from li)
select document_id, engine_id, line_index, last_value(k ignore nulls) over (partition by document_id, engine_id order by line_index rows between unbounded preceding and current row) as party from m""")
def party_marker_asof(s, sf):
    return lines.party_marker(element_lines(s, sf)).select("document_id", "engine_id", "line_index", "party")


@query(f"with {EL} select document_id, engine_id, page_number, min(bounding_box.x) x, min(bounding_box.y) y, max(bounding_box.x+bounding_box.w)-min(bounding_box.x) w, max(bounding_box.y+bounding_box.h)-min(bounding_box.y) h from el group by all")
def bbox_union(s, sf):
    return layout.union_box(S.elements(s, sf, "document_id", "engine_id", "page_number", "bounding_box"), ["document_id", "engine_id", "page_number"])


_OVER = f"""with {EL}, b as (select document_id, engine_id, page_number, artifact_id, bounding_box.x x, bounding_box.y y, bounding_box.w w, bounding_box.h h from el where page_number is not null and bounding_box.x is not null and bounding_box.y is not null and bounding_box.w is not null and bounding_box.h is not null),
hit as (select distinct a.document_id, a.engine_id, a.page_number, a.artifact_id from b a join b c using (document_id, engine_id, page_number) where a.artifact_id<>c.artifact_id
 and greatest(least(a.x+a.w,c.x+c.w)-greatest(a.x,c.x),0)*greatest(least(a.y+a.h,c.y+c.h)-greatest(a.y,c.y),0) > 0.1*(a.w*a.h+c.w*c.h-greatest(least(a.x+a.w,c.x+c.w)-greatest(a.x,c.x),0)*greatest(least(a.y+a.h,c.y+c.h)-greatest(a.y,c.y),0)))
select document_id, engine_id, page_number, count(*) boxes, count(hit.artifact_id) overlapping, count(hit.artifact_id)/count(*)>0.25 crowded from b left join hit using (document_id, engine_id, page_number, artifact_id) group by all"""


@query(_OVER)
def bbox_overlap(s, sf):
    e = S.elements(s, sf, "document_id", "engine_id", "page_number", "bounding_box").filter("page_number is not null")
    return layout.overlaps(e, ["document_id", "engine_id", "page_number"], "artifact_id")


@query(f"""with {EL} select artifact_id, least(greatest(cast(trunc(bounding_box.x*0.5) as int),0),639) x1, least(greatest(cast(trunc(bounding_box.y*0.5) as int),0),899) y1,
greatest(least(cast(trunc((bounding_box.x+bounding_box.w)*0.5) as int),640), least(greatest(cast(trunc(bounding_box.x*0.5) as int),0),639)+1) x2,
greatest(least(cast(trunc((bounding_box.y+bounding_box.h)*0.5) as int),900), least(greatest(cast(trunc(bounding_box.y*0.5) as int),0),899)+1) y2 from el where bounding_box.x is not null and bounding_box.y is not null""")
def box_scale(s, sf):
    e = S.elements(s, sf, "bounding_box").filter("bounding_box.x is not null and bounding_box.y is not null")
    return e.select("artifact_id", layout.scaled(F.col("bounding_box"), 0.5, 0.5, 640, 900).alias("p")).select("artifact_id", "p.*")


@query(f"""with {EL}, r as (select artifact_id, unnest(regexp_extract_all(text,'(?is)<tr[^>]*>(.*?)</tr>',1)) as row, generate_subscripts(regexp_extract_all(text,'(?is)<tr[^>]*>(.*?)</tr>',1),1)-1 as row_no from el where text is not null),
c as (select artifact_id, cast(row_no as int) row_no, list_filter(list_transform(regexp_extract_all(row,'(?is)<t[dh][^>]*>(.*?)</t[dh]>',1), lambda x: trim(regexp_replace(regexp_replace(x,'<[^>]*>',' ','g'),'\\s+',' ','g'))), lambda x: x<>'') k from r)
select artifact_id, row_no, array_to_string(k,'  ') as row_text, cast(len(k) as int) as n_cells from c""")
def html_row_decompose(s, sf):
    return layout.table_rows(S.elements(s, sf, "text"), "artifact_id", "text")


@query(f"""with {EL}, p as (select artifact_id, list_filter(regexp_split_to_array(text,'  +'), lambda x: trim(x)<>'') k from el where text is not null),
u as (select artifact_id, unnest(k) piece, generate_subscripts(k,1)-1 piece_no from p)
select artifact_id, cast(piece_no as int) piece_no, piece, round(coalesce(sum(length(piece)) over (partition by artifact_id order by piece_no rows between unbounded preceding and 1 preceding),0)/sum(length(piece)) over (partition by artifact_id),6) as x_share from u""")
def row_cell_split(s, sf):
    return layout.row_pieces(S.elements(s, sf, "text"), "artifact_id", "text").withColumn("x_share", F.round("x_share", 6))


@query(f"with {EL} select document_id, engine_id, round(coalesce(least(exp(avg(case when confidence>0 then ln(confidence) end)),1.0),0.92),6) as confidence from el group by all")
def token_geomean_confidence(s, sf):
    return layout.sequence_confidence(S.elements(s, sf, "document_id", "engine_id", "confidence"), ["document_id", "engine_id"], "confidence").withColumn("confidence", F.round("confidence", 6))


# ---- text functions and extractors -------------------------------------------------------------


@query(f"with {CA}, v as (select distinct value from ca where value is not null), t as (select value, {n_('value')} n from v) select value, n as normal, cast(len(regexp_extract_all(n,'[a-z0-9]+')) as int) as n_tokens, round(case when length(replace(n,' ',''))>0 then length(regexp_replace(n,'[^0-9]','','g'))/length(replace(n,' ','')) else 0 end,6) as density from t")
def text_normalize(s, sf):
    v = S.candidates(s, sf, "value").filter("value is not null").select("value").distinct()
    n = T.norm(F.col("value"))
    return v.select("value", n.alias("normal"), F.size(T.tokens(n)).alias("n_tokens"), F.round(T.digit_density(n), 6).alias("density"))


@query(f"with {EL}, m as (select artifact_id, regexp_extract_all(text,'(?:R\\$\\s*)?\\b\\d{{1,3}}(?:\\.\\d{{3}})*,\\d{{2}}\\b') k from el where text is not null) select artifact_id, cast(generate_subscripts(k,1)-1 as int) as match_no, unnest(k) as value from m")
def extract_money(s, sf):
    return C.all_values(S.elements(s, sf, "text").filter("text is not null"), "artifact_id", "text", C.MONEY)


@query(f"with {EL}, m as (select artifact_id, regexp_extract_all(text,'[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+') k from el where text is not null) select artifact_id, cast(generate_subscripts(k,1)-1 as int) as match_no, unnest(k) as value from m")
def extract_email(s, sf):
    return C.all_values(S.elements(s, sf, "text").filter("text is not null"), "artifact_id", "text", C.EMAIL)


_ID_FORM = r"\b(?:\d{2}[.,]\d{3}\.\d{3}/\d{4}-\d{2}|\d{14}|\d{3}\.\d{3}\.\d{3}-\d{2}|\d{11})\b"
_HAS = lambda x, *ws: "(" + " or ".join(f"contains({x},'{w}')" for w in ws) + ")"
_X = ascii_(f"regexp_replace(regexp_replace(v,'^[ :\\-\\t\\r\\n]+|[ :\\-\\t\\r\\n]+$','','g'),'{SPACE}+',' ','g')")


def _code_sql(p: str) -> str:
    code, after = f"regexp_extract(x,'({p})([^\n]?)',1)", f"regexp_extract(x,'({p})([^\n]?)',2)"
    return f"case when {code}<>'' and {after} not in (',','/','.') and not ({code}='116' and contains({n_('v')},'lei complementar')) and not (regexp_full_match({code},'\\d+') and coalesce(try_cast({code} as int) between 1900 and 2099,false)) then {code} end"


_CODES = "coalesce(" + ",".join(_code_sql(p) for p in (r"\b\d{2}\.\d{2}\.\d{2}\b", r"\b\d{1,2}\.\d{2}\b", r"\b\d{4}\b", r"\b\d{3}\b")) + ")"


@query(f"""with {CA}, t as (select distinct line_text v from ca where line_text is not null), u as (select v, {_X} x from t),
w as (select v, x, nullif(regexp_extract(trim(regexp_replace(x,'(?is)\\b(?:insc\\.?\\s*estadual|inscricao\\s+estadual|estadual)\\b.*$','')),'(?i)\\b(?:isento|[A-Z0-9][A-Z0-9.\\-/]{{1,20}})\\b'),'') r, regexp_extract(x,'\\b\\d{{2}}/\\d{{2}}/\\d{{4}}\\b') d from u)
select v as line_text, nullif(regexp_extract(upper(x),'\\b[A-Z]{{2}}\\b'),'') as state, nullif(array_to_string(regexp_extract_all(replace(x,'/',' '),'\\b0?\\d{{7,11}}\\b'),' '),'') as phones,
 coalesce(nullif(regexp_extract(x,'\\b\\d{{2}}/\\d{{4}}\\b'),''),nullif(d,'')) as competence, nullif(regexp_extract(x,'\\b(?:\\d{{1,2}},\\d{{1,4}}%?|\\d{{1,2}}%)'),'') as rate,
 trim(list_filter(regexp_extract_all(x,'(?:(?:R\\$\\s*)?\\b\\d{{1,3}}(?:\\.\\d{{3}})*,\\d{{2}}\\b|\\b\\d+\\.\\d{{2}}\\b)%?'), lambda m: right(m,1)<>'%')[1]) as money,
 {_CODES} as service_code from w""")
def typed_fields(s, sf):
    v = S.candidates(s, sf, "line_text").filter("line_text is not null").select("line_text").distinct()
    x = X.cleaned(F.col("line_text"))
    return v.select("line_text", X.state(x).alias("state"), X.phones(x).alias("phones"), X.competence(x).alias("competence"), V.first_match(x, X.RATE).alias("rate"), X.money(x).alias("money"), X.service_code(x).alias("service_code"))


_NO_CODE = "('ASSINATURA','AUTENTICACAO','AUTENTICIDADE','CERTIFICACAO','CODIGO','CONTROLE','DIGITAL','DOCUMENTO','ELETRONICA','ELETRONICO','ELETRONICANFSE','FISCAL','MODELO','NFSE','NFS','NOTA','PRESTADOR','RPS','SERVICO','SERVICOS','VALIDACAO','VERIFICACAO')"


@query(f"""with {CA}, t as (select distinct line_text v from ca where line_text is not null), u as (select v, {_X} x from t),
k as (select v, x, list_filter(list_transform(regexp_extract_all(regexp_replace(regexp_replace(upper(x),'-\\s+','-','g'),'\\s+-','-','g'),'\\b(?:[A-Z0-9]{{4,12}}-[A-Z0-9]{{2,12}}(?:-[A-Z0-9]{{2,12}}){{0,4}}|[A-Z0-9]{{5,12}})\\b'), lambda c: trim(c,'-')),
 lambda c: replace(c,'-','') not in {_NO_CODE} and len(list_filter(string_split(c,'-'), lambda p: p in {_NO_CODE}))=0 and length(replace(c,'-',''))>=5 and regexp_matches(c,'\\d') and not regexp_full_match(replace(c,'-',''),'\\d+') and (contains(c,'-') or regexp_matches(c,'[A-Z]')))[1] code,
 regexp_extract(x,'\\b\\d{{2}}/\\d{{2}}/\\d{{4}}\\b') d from u),
n as (select *, case when d<>'' then trim(substr(x,1,strpos(x,d)-1)) else x end h from k),
m as (select *, regexp_extract_all(h,'\\b\\d[\\d.]{{0,11}}\\b') every from n)
select v as line_text, case when not contains(lower(x),'http') and not contains(x,'/') then code end as verification_code,
 case when h<>'' and not contains(h,'/') then coalesce(list_filter(every, lambda q: regexp_full_match(q,'\\d+'))[-1], every[-1]) end as note_number from m""")
def typed_codes(s, sf):
    v = S.candidates(s, sf, "line_text").filter("line_text is not null").select("line_text").distinct()
    x = X.cleaned(F.col("line_text"))
    return v.select("line_text", X.verification_code(x).alias("verification_code"), X.note_number(x).alias("note_number"))


def _before(x: str, p: str) -> str:
    """What stands before the first match; all where there is none."""
    return f"case when regexp_matches({x},{lit(p)}) then regexp_extract({x},{lit('(?s)^(.*?)(?:' + p + ')')},1) else {x} end"


_STRIP = lambda x: f"regexp_replace({x},'^[ :\\-\\t\\r\\n]+|[ :\\-\\t\\r\\n]+$','','g')"
_NO_TEXT = "('de servicos','dos servicos','prestador de servicos','tomador de servicos','discriminacao do servico','discriminacao dos servicos','do servico','do servicos')"
_AMOUNT = r"(?:R\$\s*)?\b\d{1,3}(?:\.\d{3})*,\d{2}\b|\b\d+\.\d{2}\b"
_LETTERS = "length(replace(%s,' ',''))"


@query(f"""with {CA}, t as (select distinct line_text v from ca where line_text is not null), u as (select v, regexp_replace({_STRIP('v')},'{SPACE}+',' ','g') c from t), w as (select v, c, {ascii_('c')} x from u where c<>''),
nm as (select v, {_before('c', r"(?i)\b(?:cnpj|cpf|(?:nome|name)\s+fantasia|endere[çc]o|e\s*mail|email|fone|insc\.?|inscri[çc][aã]o|munic[íi]pio|telefone|uf)\b")} h from w),
n2 as (select v, regexp_replace(regexp_replace({_STRIP("regexp_replace(regexp_replace(regexp_replace(regexp_replace(h," + lit(_ID_FORM) + ",'','g'),'\\b\\d{11,14}\\b$',''),'[\\s:,\\-]+\\d[\\d.\\s]*$',''),'" + SPACE + "+',' ','g')")},'^[ :,\\-]+',''),'[ :,\\-]+$','') h from nm),
rg as (select v, trim(nullif(regexp_extract(trim({_before('x', r"(?i)\b(?:insc\.?\s*estadual|inscricao\s+estadual|estadual)\b")}),'(?i)\\b(?:isento|[A-Z0-9][A-Z0-9.\\-/]{{1,20}})\\b'),''),' .:-') r from w),
na as (select v, {_STRIP(_before('c', r"(?i)\b(?:c[óo]digo|data|emiss[aã]o|local\s+d[aeo]|valor|base\s+de\s+c[aá]lculo)\b"))} h from w),
ci as (select v, {_STRIP("regexp_replace(" + _STRIP(_before('c', r"(?i)\b(?:data|c[óo]digo|natureza|valor|base\s+de\s+c[aá]lculo|iss)\b")) + ",'^\\d{3,5}\\s+','')")} h from w),
d1 as (select v, regexp_replace(c,'(?i)^(?:descri[cç][aã]o|discrimina[cç][aã]o)(?:\\s+d[oe]s?\\s+servi[çc]os?)?\\s*:?\\s*','') h from w),
ds as (select v, {_STRIP(_before('h', r"(?i)\b(?:atividade|base\s+de\s+c[aá]lculo|c[óo]digo\s+do\s+servi[çc]o|informa[çc][õo]es\s+adicionais|local\s+d[aeo]|natureza|outras\s+informa[çc][õo]es|valor|vencimento)\b"))} h from d1),
na2 as (select v, h, {n_('h')} n from na), ci2 as (select v, h, {n_('h')} n from ci), ds2 as (select v, h, {n_('h')} n, regexp_extract_all({n_('h')},'[a-z0-9]+') k from ds)
select v as line_text, case when len(regexp_extract_all({n_('n2.h')},'[a-z0-9]+'))>=2 then n2.h end as provider_name, case when lower(r)='isento' then upper(r) else r end as provider_municipal_registration,
 case when na2.n<>'' and na2.n not in {_NO_TEXT} and na2.n not in ('da operacao','de operacao') and {_LETTERS % "replace(na2.n,'@','')"}>=3 and not regexp_matches(na2.h,{lit(_AMOUNT)}) then na2.h end as operation_nature,
 case when ci2.n<>'' and ci2.n not in {_NO_TEXT} and regexp_matches(replace(ci2.n,'@',''),'[a-z]') and ci2.n not in ('da prestacao do servico','de prestacao','do servico')
  and not {_HAS('ci2.n', 'descricao do servico', 'descricao dos servicos', 'outras informacoes', 'servico local prestacao', 'aliquota', 'situacao trib', 'tributad', 'local de prestacao', 'prestacao do servico', 'servicos prestados', 'ervicos prestados')}
  and {_LETTERS % "replace(ci2.n,'@','')"}>=3 and not regexp_matches(ci2.h,{lit(_AMOUNT)}) then replace(regexp_replace(ci2.h,'\\s*!\\s*','/','g'),' - ','/') end as service_city,
 case when ds2.n<>'' and ds2.n not in {_NO_TEXT} and not {_HAS('ds2.n', 'aliquota', 'base de calculo', 'informacoes relevantes', 'servico local prestacao', 'valor iss', 'valor liquido', 'valor total')}
  and (len(k)>=3 or len(k)>0 and len(list_filter(k, lambda q: not regexp_full_match(q,'[a-z]{{4,}}') or q in ('aliquota','base','codigo','cofins','deducoes','desconto','inss','iss','item','local','municipio','natureza','pis','retencoes','valor','valores')))=0) then ds2.h end as service_description
from t left join n2 using (v) left join rg using (v) left join na2 using (v) left join ci2 using (v) left join ds2 using (v)""")
def typed_texts(s, sf):
    v = S.candidates(s, sf, "line_text").filter("line_text is not null").select("line_text").distinct()
    t = F.col("line_text")
    names = ("provider_name", "provider_municipal_registration", "operation_nature", "service_city", "service_description")
    return v.select("line_text", *[X.typed(F.lit(n), t).alias(n) for n in names])


@query()
def typed_inline(s, sf):
    v = S.candidates(s, sf, "line_text").filter("line_text is not null").select("line_text").distinct()
    t = F.col("line_text")
    return v.select("line_text", X.inline_party_name(t).alias("inline_name"), X.inline_state(t).alias("inline_state")).filter("inline_name is not null or inline_state is not null")


@query(f"""with {CA}, t as (select distinct value v from ca where value is not null), u as (select v, {ascii_("regexp_replace(trim(v),'" + SPACE + "+',' ','g')")} x from t),
a as (select v, regexp_extract(x,'\\b([A-Za-z0-9._%+-]{{2,}}?)\\s+[OQ0]([A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+)\\b',1) u1, regexp_extract(x,'\\b([A-Za-z0-9._%+-]{{2,}}?)\\s+[OQ0]([A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+)\\b',2) h1,
 regexp_extract(x,'\\b([A-Za-z0-9._%+-]{{2,}}?)[OQ0][)\\]]?([A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+)\\b',1) u2, regexp_extract(x,'\\b([A-Za-z0-9._%+-]{{2,}}?)[OQ0][)\\]]?([A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+)\\b',2) h2 from u),
b as (select v, coalesce(case when u1<>'' and not starts_with(lower(h1),'www.') then lower(u1||'@'||h1) end, case when u2<>'' and not starts_with(lower(h2),'www.') then lower(u2||'@'||h2) end) email from a)
select v as value, email from b where email is not null""")
def repair_email(s, sf):
    v = S.candidates(s, sf, "value").filter("value is not null").select("value").distinct()
    return v.select("value", X.repaired_email(F.col("value")).alias("email")).filter("email is not null")


def _valid_sql(v: str) -> str:
    d = f"regexp_replace({v},'[^0-9]','','g')"
    dig = lambda i: f"cast(substr({d},{i},1) as int)"
    chk = lambda ws: f"(case when (({'+'.join(f'{dig(i + 1)}*{w}' for i, w in enumerate(ws))})%11)<2 then 0 else 11-(({'+'.join(f'{dig(i + 1)}*{w}' for i, w in enumerate(ws))})%11) end)"
    w14 = [6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2]
    same = f"{d}=repeat(substr({d},1,1),length({d}))"
    return f"case when length({d})=11 and not {same} then {chk(list(range(10, 1, -1)))}={dig(10)} and {chk(list(range(11, 1, -1)))}={dig(11)} when length({d})=14 and not {same} then {chk(w14[1:])}={dig(13)} and {chk(w14)}={dig(14)} else false end"


@query(f"with {CA}, v as (select distinct value from ca where field_name like '%\\_document' escape '\\' and value is not null) select value, {_valid_sql('value')} as valid, case length(regexp_replace(value,'[^0-9]','','g')) when 14 then regexp_replace(regexp_replace(value,'[^0-9]','','g'),'^(..)(...)(...)(....)(..)$','\\1.\\2.\\3/\\4-\\5') when 11 then regexp_replace(regexp_replace(value,'[^0-9]','','g'),'^(...)(...)(...)(..)$','\\1.\\2.\\3-\\4') end as masked from v")
def document_checkdigits(s, sf):
    v = S.candidates(s, sf, "field_name", "value").filter(F.col("field_name").endswith("_document") & F.col("value").isNotNull()).select("value").distinct()
    return v.select("value", V.valid_document(F.col("value")).alias("valid"), V.document_mask(F.col("value")).alias("masked"))


def _decimal_sql(v: str) -> str:
    x = f"regexp_replace(regexp_replace(trim({v}),'R\\$','','g'),'[\\s\\p{{Z}}\\x{{85}}]','','g')"
    y = f"case when contains({x},',') and contains({x},'.') then replace(replace({x},'.',''),',','.') when contains({x},',') then replace({x},',','.') else {x} end"
    return f"case when regexp_matches({y},'^[+-]?(?:\\d+\\.?\\d*|\\.\\d+)$') then try_cast({y} as decimal(28,6)) end"


@query(f"with {CA}, v as (select distinct value from ca where field_name like '%\\_amount' escape '\\' and value is not null) select value, {_decimal_sql('value')} as amount from v")
def decimal_parse(s, sf):
    v = S.candidates(s, sf, "field_name", "value").filter(F.col("field_name").endswith("_amount") & F.col("value").isNotNull()).select("value").distinct()
    return v.select("value", V.decimal(F.col("value")).alias("amount"))


@query(f"""with {CA}, v as (select distinct value, trim(value) x from ca where field_name='issue_date' and value is not null)
select value, case when regexp_matches(x,'^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') then cast(try_strptime(x,'%d/%m/%Y') as date) when regexp_matches(x,'^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$') then cast(try_strptime(x,'%Y-%m-%d') as date)
 when regexp_matches(x,'^\\d{{1,2}}/\\d{{4}}$') then cast(try_strptime('1/'||x,'%d/%m/%Y') as date) end as day from v""")
def date_parse(s, sf):
    v = S.candidates(s, sf, "field_name", "value").filter("field_name = 'issue_date' and value is not null").select("value").distinct()
    return v.select("value", V.date(F.col("value")).alias("day"))


# ---- labels, tables, candidates ----------------------------------------------------------------


def _alias_values() -> str:
    rows = sorted({(f, " ".join(a.replace("_", " ").replace("-", " ").split())) for f, xs in D.ALIASES.items() for a in [*xs, f]})
    return "(values " + ",".join(f"('{f}','{a}')" for f, a in rows) + ") al(field_name, alias)"


@query(f"""with {CA}, t as (select cand_id, regexp_extract_all({n_('line_text')},'[a-z0-9]+') k from ca where line_text is not null),
x as (select cand_id, k, unnest(range(1,len(k)+1)) i from t),
h as (select cand_id, field_name, alias, i-1 as start_token, i-2+len(string_split(alias,' ')) as end_token, len(string_split(alias,' ')) n from x join {_alias_values()} on split_part(alias,' ',1)=k[i] and array_to_string(k[i:i+len(string_split(alias,' '))-1],' ')=alias)
select cand_id, field_name, alias, cast(start_token as int) as start_token, cast(end_token as int) as end_token from (select cand_id, field_name, alias, n, min(start_token) start_token, min(end_token) end_token from h group by all) qualify row_number() over (partition by cand_id, field_name order by end_token desc, n desc, start_token)=1""")
def alias_label_match(s, sf):
    c = S.candidates(s, sf, "line_text").filter("line_text is not null").select("cand_id", F.col("line_text").alias("text"))
    return C.label_matches(c, ["cand_id"], C.alias_table(s))


@query(f"with {LINES}, v as (select *, nullif(regexp_extract(text,'\\b\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}\\b'),'') d from li), a as (select document_id, engine_id, line_index, lead(d,1) over w a1, lead(d,2) over w a2, lead(d,3) over w a3, lead(d,4) over w a4 from v window w as (partition by document_id, engine_id order by line_index)) select document_id, engine_id, line_index, coalesce(a1,a2,a3,a4) as nearby, case when a1 is not null then 1 when a2 is not null then 2 when a3 is not null then 3 when a4 is not null then 4 end as distance from a")
def label_value_nearby(s, sf):
    li = element_lines(s, sf)
    f = C.following(li, ["document_id", "engine_id"], "line_index", 4, V.first_match(F.col("text"), C.DATE))
    return f.select("document_id", "engine_id", "line_index", "nearby", "distance")


@query(f"with {LINES} select document_id, engine_id, line_index, coalesce(lead(text,1) over w,'') as next_1, concat_ws(' ',lead(text,1) over w,lead(text,2) over w) as next_2, concat_ws(' ',lead(text,1) over w,lead(text,2) over w,lead(text,3) over w) as next_3 from li window w as (partition by document_id, engine_id order by line_index)")
def nearby_window_concat(s, sf):
    return C.nearby_text(element_lines(s, sf), ["document_id", "engine_id"], "line_index").select("document_id", "engine_id", "line_index", "next_1", "next_2", "next_3")


@query(f"""with {CA} select cand_id, concat_ws(':',document_id,'normalizer',field_name,cast(line_index as varchar),cast(len(source_element_ids) as varchar),substr(sha1(coalesce(value,'')),1,12)) as computed_id,
round(case when value_source='ocr_corrected_email' then least(least(greatest(coalesce(confidence,0.5)+0.08,0),1)*0.75,0.7) else least(greatest(coalesce(confidence,0.5)+case value_source when 'financial_table' then 0.10 when 'regex' then 0.03 else 0.08 end,0),1) end,6) as boosted from ca""")
def candidate_confidence_id(s, sf):
    c = S.candidates(s, sf, "document_id", "field_name", "line_index", "source_element_ids", "value", "confidence", "value_source")
    return c.select("cand_id", C.candidate_id(F.col("document_id"), F.col("field_name"), F.col("line_index"), F.when(F.col("source_element_ids").isNotNull(), F.size("source_element_ids")), F.col("value")).alias("computed_id"), F.round(C.boosted(F.col("confidence"), F.col("value_source")), 6).alias("boosted"))


@query(f"with {CA} select document_id, engine_id, field_name, count(distinct {n_('value')}) as n_values from ca where value is not null group by all")
def candidate_distinct_values(s, sf):
    return C.distinct_values(S.candidates(s, sf, "document_id", "engine_id", "field_name", "value"))


@query(f"with {CA} select document_id, engine_id, field_name, cand_id, value, min(candidate_ordinal) over k as first_ordinal from ca window k as (partition by document_id, engine_id, field_name, {n_('value')}, coalesce(section_name,'')) qualify row_number() over (partition by document_id, engine_id, field_name, {n_('value')}, coalesce(section_name,'') order by coalesce(confidence,0) desc, candidate_ordinal, cand_id)=1")
def candidate_dedupe(s, sf):
    return C.deduplicated(S.candidates(s, sf, "document_id", "engine_id", "field_name", "value", "section_name", "confidence", "candidate_ordinal")).select("document_id", "engine_id", "field_name", "cand_id", "value", "first_ordinal")


def _rank_sql() -> str:
    has = lambda t, *ps: "(" + " or ".join(f"contains({t},'{p}')" for p in ps) + ")"
    add = lambda c, x: f"case when {c} then {x} else 0.0 end"
    zero = "(regexp_matches(v,'\\d') and not regexp_matches(v,'[1-9]'))"
    money = ",".join(f"'{f}'" for f in [*D.MONEY_FIELDS, "iss_rate"])
    others = ",".join(f"'{f}'" for f in D.MONEY_FIELDS if f not in ("gross_amount", "taxable_amount", "iss_amount", "net_amount", "iss_withheld_amount"))
    date = f"{add(has('lb', 'emissao') + ' or ' + has('ln', 'emissao', 'data hora'), 0.45)}+{add(has('ln', 'autorizacao', 'fato gerador', 'rps', 'vencimento'), -0.65)}"
    num = f"{add(has('ln', 'numero da nota', 'numero da nfs', 'numero da nf', 'nota no'), 0.45)}+{add(has('ln', 'rps', 'recibo provisorio'), -0.55)}-least(length(regexp_replace(v,'[^0-9]','','g')),12)*0.005"
    code = f"{add(has('ln', 'codigo de verificacao', 'codigo verificador', 'certificacao'), 0.5)}+{add('contains(v,' + chr(39) + '-' + chr(39) + ')', 0.2)}+{add("upper(" + n_("v") + ") in ('ASSINATURA','AUTENTICACAO','AUTENTICIDADE','CERTIFICACAO','CODIGO','CONTROLE','DIGITAL','DOCUMENTO','ELETRONICA','ELETRONICO','ELETRONICANFSE','FISCAL','MODELO','NFSE','NFS','NOTA','PRESTADOR','RPS','SERVICO','SERVICOS','VALIDACAO','VERIFICACAO')", -1.0)}"
    common = f"case coalesce(value_source,'') when 'financial_table' then 0.35 when 'next_line_table' then 0.15 else 0.0 end+{add(has('ln', 'credito', 'trib federais', 'total trib'), -0.45)}"
    own = f"case when field_name='gross_amount' then {add(has('lb', 'valor bruto', 'valor total', 'valor servico'), 0.25)} when field_name='taxable_amount' then {add(has('lb', 'base'), 0.25)} when field_name='iss_rate' then {add(has('lb', 'aliquota'), 0.25)}+{add(zero, -0.85)}+{add('right(v,1)=' + chr(39) + '%' + chr(39), 0.10)} when field_name='iss_amount' then {add(has('lb', 'valor iss', 'issqn devido'), 0.25)} when field_name='net_amount' then {add(has('lb', 'valor liquido'), 0.25)}+{add(has('ln', 'credito'), -0.55)} when field_name in ({others}) then {add(zero, 0.08)} else 0.0 end"
    return f"coalesce(confidence,0)+case when field_name='issue_date' then {date} when field_name='nfse_number' then {num} when field_name='verification_code' then {code} when field_name in ({money}) then {common}+{own} else 0.0 end"


_SINGLE = ",".join(f"'{f}'" for f in D.SINGLETONS)


@query(f"with {CA}, t as (select *, coalesce(value,'') v, {n_('line_text')} ln, {n_('label_text')} lb from ca where field_name in ({_SINGLE})), r as (select *, round(cast({_rank_sql()} as double),6) rank_score from t) select document_id, engine_id, field_name, cand_id, value, rank_score from r qualify row_number() over (partition by document_id, engine_id, field_name order by rank_score desc, coalesce(confidence,0) desc, coalesce(line_index,0), candidate_ordinal, cand_id)=1")
def candidate_singleton_rank(s, sf):
    return C.best_singletons(S.candidates(s, sf, "document_id", "engine_id", "field_name", "value", "label_text", "line_text", "value_source", "confidence", "line_index", "candidate_ordinal"))


def _limit_sql() -> str:
    return "case field_name " + " ".join(f"when '{f}' then {x}" for f, x in D.REVIEW_THRESHOLDS.items()) + f" else {D.REVIEW_DEFAULT} end"


_MERGED = " or ".join(f"contains({n_('line_text')},'{p}')" for p in ("credito", "trib federais", "total trib", "linha digitavel"))


@query(f"""with {CA}, nv as (select document_id, engine_id, field_name, count(distinct {n_('value')}) n_values from ca where value is not null group by all)
select cand_id, concat_ws(',', case when confidence<{_limit_sql()} then 'low_confidence' end, case when section_confidence<0.65 then 'low_section_confidence' end, case when section_override_applied then 'section_inferred_from_field' end,
case when n_values>1 then 'multiple_candidates' end, case when value_source in ('nearby_line','nearby_lines') then 'nearby_value' end, case when value_source='next_line_table' then 'table_value' end, case when value_source='ocr_corrected_email' then 'email_ocr_corrected' end,
case when field_name like '%\\_email' escape '\\' and ocr_correction_applied then 'email_ocr_separator_uncertain' end, case when field_name='service_code' and regexp_matches(value,'^\\d{{3,4}}$') then 'service_code_format_uncertain' end, case when field_name='iss_rate' and right(coalesce(value,''),1)<>'%' then 'rate_without_percent' end,
case when field_name in ({",".join(f"'{f}'" for f in [*D.MONEY_FIELDS, "iss_rate"])}) and coalesce(value_source,'') not in ('label_tail','next_line','next_line_table','inline') and ({_MERGED}) then 'merged_financial_context' end) as reasons
from ca left join nv using (document_id, engine_id, field_name)""")
def candidate_review_flags(s, sf):
    return C.review_flags(S.candidates(s, sf, "document_id", "engine_id", "field_name", "value", "line_text", "value_source", "confidence", "section_confidence", "section_override_applied", "ocr_correction_applied")).select("cand_id", F.array_join("review_reasons", ",").alias("reasons"))


# ---- candidates made from lines ----------------------------------------------------------------


@query("select field_name, words, n_words from (" + " union all ".join(f"select '{f}' field_name, '{w}' words, {len(w.split())} n_words" for _, f, _l, w, _n, _p in generate.label_table() if f) + ")")
def candidate_label_table(s, sf):
    rows = [(f, w, n) for _, f, _label, w, n, _p in generate.label_table() if f]
    return s.createDataFrame(rows, "field_name string, words string, n_words int")


def _classified(s: SparkSession, sf: str) -> DataFrame:
    return lines.classify_sections(element_lines(s, sf))


_LABEL_ROWS = "(values " + ",".join(f"({r},{lit(f) if f else 'null'},'{w}',{n},{lit(x) if x else 'null'})" for r, f, _l, w, n, x in generate.label_table()) + ") lt(rank, field, words, n, what)"


@query(_FOLD + f""", g2 as (select *, row_number() over (partition by document_id, engine_id order by p, top, lft, ord, b nulls first, l nulls first)-1 lx from g),
e2 as (select g2.document_id, g2.engine_id, g2.lx, row_number() over (partition by g2.document_id, g2.engine_id, g2.lx order by w.x, w.ordinal, w.t)-1 ei, regexp_extract_all({n_('w.t')},'[a-z0-9]+') k from w join g2 on w.document_id is not distinct from g2.document_id and w.engine_id is not distinct from g2.engine_id and w.p=g2.p and w.b is not distinct from g2.b and w.l=g2.l),
tk as (select document_id, engine_id, lx, ei, unnest(k) tok, generate_subscripts(k,1) ti from e2), ar as (select document_id, engine_id, lx, list(tok order by ei, ti) wd, list(ei order by ei, ti) el from tk group by all), ps as (select *, unnest(range(1,len(wd)+1)) ap from ar),
ht as (select document_id, engine_id, lx, wd, el, rank, field, what, n, min(ap) ap from ps join {_LABEL_ROWS} on wd[ap]=split_part(words,' ',1) and array_to_string(wd[ap:ap+n-1],' ')=words group by all),
hs as (select ht.*, {_STEP} sec, coalesce(list_max(list_filter(range(1,ap+1), lambda i: wd[i]='prestador')),0) lp, coalesce(list_max(list_filter(range(1,ap+1), lambda i: wd[i]='tomador')),0) lr from ht join st on st.document_id is not distinct from ht.document_id and st.engine_id is not distinct from ht.engine_id and st.line_index=ht.lx),
pt as (select *, case when sec not in ('provider','recipient') then sec when lp>lr then 'provider' when lr>lp then 'recipient' when sec='recipient' and coalesce(list_position(wd,'tomador'),0)>ap and what is not null then 'provider' else sec end party from hs),
fd as (select document_id, engine_id, lx, rank, n, el[ap+n-1] stop, case when what is not null and party in ('provider','recipient') then party||'_'||what else field end f from pt),
ch as (select *, min(rank) over (partition by document_id, engine_id, lx, f) r0 from fd where f is not null qualify row_number() over (partition by document_id, engine_id, lx, f order by case when f in ('operation_nature','service_city','service_description') then -n else -stop end, case when f in ('operation_nature','service_city','service_description') then stop else 0 end, rank)=1)
select document_id, engine_id, cast(lx as int) as line_index, cast(row_number() over (partition by document_id, engine_id, lx order by stop, r0)-1 as int) as place, f as field, cast(stop as int) as last_element, n from ch""")
def line_labels(s, sf):
    d = generate.kept(generate.label_hits(_classified(s, sf)), F.size("labels") > 0)
    return d.select("document_id", "engine_id", "line_index", F.posexplode("labels").alias("place", "m")).select("document_id", "engine_id", "line_index", "place", "m.field", F.col("m.stop").alias("last_element"), "m.n")


@query()
def line_candidates(s, sf):
    """Every candidate that the steps give, with its source."""
    return generate.candidates_from_lines(_classified(s, sf)).drop("bounding_box", "section_reasons", "source_element_ids")


_WORD = lambda x, w: f"contains(' '||{x}||' ',' {w} ')"


@query(_FOLD + rf""", cl as (select st.document_id, st.engine_id, st.line_index, {_STEP} sec, li.text as t, {ascii_('li.text')} x, {n_('li.text')} n from st join li on li.document_id is not distinct from st.document_id and li.engine_id is not distinct from st.engine_id and li.line_index=st.line_index),
ok as (select * from cl where sec<>'ignored_billing'), sp as (select *, regexp_extract_all(x,{lit(_ID_FORM)}) ids, regexp_split_to_array(x,{lit(_ID_FORM)}) pc from ok where regexp_matches(x,{lit(_ID_FORM)})),
ii as (select *, unnest(range(1,len(ids)+1)) k from sp), pp as (select *, length(list_reduce([''] || list_transform(range(1,k), lambda i: pc[i]||ids[i]), lambda a, b: a||b))+length(pc[k]) l from ii),
qq as (select *, ids[k] v, {n_('substr(t,1,l)')} bf, {n_('substr(t,l+1+length(ids[k]))')} af, regexp_replace(ids[k],'[^0-9]','','g') dg from pp),
idc as (select document_id, engine_id, line_index, case when length(dg)=14 then regexp_replace(dg,'^(..)(...)(...)(....)(..)$','\1.\2.\3/\4-\5') else regexp_replace(dg,'^(...)(...)(...)(..)$','\1.\2.\3-\4') end as value, sec,
 case when sec not in ('provider','recipient') then sec when {_WORD('bf','tomador')} then 'recipient' when {_WORD('bf','prestador')} then 'provider'
  when sec='recipient' and {_WORD('af','tomador')} and {_HAS('bf','cnpj','cpf')} and {_HAS('bf','bairro','e mail','email','endereco','fantasia','municipio','nome razao','pais','razao social','social','telefone')} then 'provider' else sec end who
 from qq where ({_HAS('n','cnpj','cpf')} or (sec in ('provider','recipient') and not regexp_full_match(v,'\d+') and {_HAS('n','insc','inscricao','municipal','razao','social')})) and not (regexp_full_match(v,'\d{{11}}') and {_HAS('bf','telefone','fone','celular')})),
every as (select document_id, engine_id, line_index, case when who='recipient' then 'recipient_document' else 'provider_document' end field_name, value, 'document pattern' label_text, sec from idc
 union all select document_id, engine_id, line_index, 'issue_date', unnest(regexp_extract_all(x,'\b\d{{2}}/\d{{2}}/\d{{4}}\b')), 'date pattern', sec from ok where contains(n,'emissao')
 union all select document_id, engine_id, line_index, 'service_code', value, 'service_code pattern', sec from (select document_id, engine_id, line_index, sec, {_CODES} as value from (select *, t v from ok) where sec='service' and {_HAS('n','atividade','cnae','cod servico','codigo atividade','codigo do servico','codigo servico','item da lista','lista de servico','subitem','subitens')}) where value is not null)
select document_id, engine_id, line_index, field_name, value, label_text, case when starts_with(field_name,'provider_') then 'provider' when starts_with(field_name,'recipient_') then 'recipient' else sec end as section_name, sec as raw_section_name from every""")
def pattern_candidates(s, sf):
    """Identity numbers, dates of issue and service codes by form and context. Mailboxes have a query of their own (Unicode word limits)."""
    c = generate.built(generate.from_patterns(generate.prepared(_classified(s, sf)))).filter("label_text <> 'email pattern'")
    return c.select("document_id", "engine_id", "line_index", "field_name", "value", "label_text", "section_name", "raw_section_name")


@query()
def pattern_mailboxes(s, sf):
    c = generate.built(generate.from_patterns(generate.prepared(_classified(s, sf)))).filter("label_text = 'email pattern'")
    return c.select("document_id", "engine_id", "line_index", "field_name", "value", F.round("confidence", 6).alias("confidence"))


@query()
def generated_candidates(s, sf):
    """From elements to the chosen candidates with their review flags."""
    c = generate.candidates(S.elements(s, sf, *lines.COLUMNS))
    return c.select("document_id", "engine_id", "field_name", "value", "line_index", "value_source", "section_name", F.round("confidence", 6).alias("confidence"), "review_status", F.array_join("review_reasons", ",").alias("review_reasons"))


@query()
def generated_fields(s, sf):
    """The whole way: elements, lines, sections, candidates, resolved fields."""
    c = cut(generate.candidates(S.elements(s, sf, *lines.COLUMNS)))
    r = resolve.resolved(resolve.scored(c))
    return r.select("document_id", "engine_id", "field_name", "value", "status", F.round("confidence", 6).alias("confidence"))


_LABELS = "(values " + ",".join(f"({i},{lit(f) if f else 'null'},'{w}',{len(w.split())})" for i, (f, w) in enumerate(sorted(fintable.LABELS, key=lambda x: -len(x[1])))) + ") lb(rank, field, label, n)"


@query(_FOLD + f""", vl as (select st.document_id, st.engine_id, st.line_index, string_split(sc.n,' ') w from st join sc on st.document_id is not distinct from sc.document_id and st.engine_id is not distinct from sc.engine_id and st.line_index=sc.line_index where {_STEP}='values'),
wp as (select *, unnest(range(1,len(w)+1)) p from vl), ht as (select document_id, engine_id, line_index, [{{'field':field,'label':label,'start':p-1,'stop':p-1+n}}] h, rank, p from wp join {_LABELS} on w[p]=split_part(label,' ',1) and array_to_string(w[p:p+n-1],' ')=label),
pl as (select document_id, engine_id, line_index, list_reduce(list(h order by rank, p), lambda acc, x: case when len(list_filter(acc, lambda y: y.start<x[1].stop and x[1].start<y.stop))=0 then acc||x else acc end) k from ht group by all),
ex as (select document_id, engine_id, line_index, unnest(k) c from pl)
select document_id, engine_id, line_index, cast(row_number() over (partition by document_id, engine_id, line_index order by c.start)-1 as int) as column_no, c.field field, c.label as label, cast(c.start as int) as start, cast(c.stop as int) stop from ex""")
def value_table_columns(s, sf):
    d = fintable.next_of(_classified(s, sf))
    return d.select("document_id", "engine_id", "line_index", F.posexplode("fin_columns").alias("column_no", "c")).select("document_id", "engine_id", "line_index", "column_no", "c.*")


_VALUE = r"(?:R\$\s*-?\s*)?\d{1,3}(?:\.\d{3})*,\d{2,4}\s*%?|(?:R\$\s*-?\s*)?\d+,\d{2,4}\s*%?|\d{1,2}\s*%"
_JOIN_NUMBERS = lambda x: rf"regexp_replace(regexp_replace({x},'\b(\d+)\s+,\s*(\d{{2,4}})\b','\1,\2','g'),'(R\$)\s+(-)\s+','\1 \2 ','g')"
_SPLIT_END = r"'^\s*,\s*\d{2}\s*$'"
_ZERO = lambda x: f"(regexp_matches({x},'\\d') and not regexp_matches({x},'[1-9]'))"
_RATE_LIKE = lambda x: f"(right({x},1)='%' or not contains(upper({x}),'R$') and not {_ZERO(x)} and coalesce(try_cast(replace(replace(regexp_replace({x},'[^\\d,.\\-]','','g'),'.',''),',','.') as double)>0 and try_cast(replace(replace(regexp_replace({x},'[^\\d,.\\-]','','g'),'.',''),',','.') as double)<=100,false))"


def _take(k: int) -> str:
    """One step over the k-th next line: (ended, taken) after those before it."""
    part, head = f"regexp_matches(t{k},{_SPLIT_END})", f"n{k} in {_NO_TEXT}"
    has = f"(regexp_matches({_JOIN_NUMBERS(f't{k}')},{lit(_VALUE)}) or {part})"
    end, had = (f"e{k - 1}", f"len(v{k - 1})") if k > 1 else ("false", "0")
    old = f"v{k - 1}" if k > 1 else "[]::int[]"
    stop = f"({end} or t{k} is null or s{k}<>'values' or (not {head} and {had}>0 and (h{k} or not {has})))"
    take = f"(not {stop} and not {head} and {has})"
    return f"coalesce({stop} or ({take} and {had}>=1 and not {part}),true) e{k}, case when {take} then {old} || [{k}] else {old} end v{k}"


def _side_sql(c: str, m: str) -> str:
    """Columns c and amounts m of one side as pairs."""
    pair = lambda i, j: f"{{'f':{c}[{i}].field,'v':{m}[{j}],'l':{c}[{i}].label}}"
    ends = f"[{pair(-1, -1)}]"
    order = f"list_transform(range(1,len({c})+1), lambda i: {{'f':{c}[i].field,'v':{m}[i],'l':{c}[i].label}})"
    base = f"list_transform(list_filter({c}, lambda y: y.field='taxable_amount')[1:1], lambda y: {{'f':y.field,'v':{m}[1],'l':y.label}})"
    every = f"case when len({c})=0 or len({m})=0 then [] when len({m})>=len({c}) then {order} when len({m})=1 then case when len({c})<=2 then {base} else [] end when ({c}[1].field is null or {c}[1].field in ('deductions_amount','other_retentions_amount')) and {_ZERO(m + '[1]')} then [{pair(1, 1)}] || {ends} else {ends} end"
    return f"list_filter({every}, lambda q: q.f is not null and case when q.f='iss_rate' then {_RATE_LIKE('q.v')} when q.f='deductions_amount' and not {_ZERO('q.v')} then false else right(q.v,1)<>'%' end)"


_AMOUNTS = lambda v: f"list_filter({v}, lambda q: right(q,1)<>'%')"


@query(_FOLD + f""", al as (select st.document_id, st.engine_id, st.line_index, {_STEP} sec, sc.n n, li.text as t from st join sc on st.document_id is not distinct from sc.document_id and st.engine_id is not distinct from sc.engine_id and st.line_index=sc.line_index join li on st.document_id is not distinct from li.document_id and st.engine_id is not distinct from li.engine_id and st.line_index=li.line_index),
wp as (select document_id, engine_id, line_index, string_split(n,' ') w, unnest(range(1,len(string_split(n,' '))+1)) p from al where sec='values'), ht as (select document_id, engine_id, line_index, [{{'field':field,'label':label,'start':p-1,'stop':p-1+n}}] h, rank, p from wp join {_LABELS} on w[p]=split_part(label,' ',1) and array_to_string(w[p:p+n-1],' ')=label),
pl as (select document_id, engine_id, line_index, list_reduce(list(h order by rank, p), lambda acc, x: case when len(list_filter(acc, lambda y: y.start<x[1].stop and x[1].start<y.stop))=0 then acc||x else acc end) k from ht group by all),
cs as (select document_id, engine_id, line_index, list(c order by c.start) c from (select document_id, engine_id, line_index, unnest(k) c from pl) group by all),
aw as (select al.*, cs.c c, cs.c is not null hc from al left join cs on al.document_id is not distinct from cs.document_id and al.engine_id is not distinct from cs.engine_id and al.line_index=cs.line_index),
nx as (select *, {", ".join(f"lead({x},{k}) over o {y}{k}" for k in (1, 2, 3) for x, y in (("sec", "s"), ("n", "n"), ("t", "t"), ("hc", "h")))} from aw window o as (partition by document_id, engine_id order by line_index)),
hd as (select * from nx where sec='values' and c is not null and not {_HAS('n', 'disp ret', 'igual ou menor', 'lei ', 'lei complementar', 'pgto', 'transparencia', 'valor aproximado')} and (len(list_filter(c, lambda y: y.field is not null))>=2 or len(c)>=2 and len(list_filter(c, lambda y: y.field='iss_rate'))>0)),
s1 as (select *, {_take(1)} from hd), s2 as (select *, {_take(2)} from s1), s3 as (select *, {_take(3)} from s2),
tx as (select *, array_to_string(list_transform(v3, lambda i: case i when 1 then t1 when 2 then t2 else t3 end),' ') x from s3 where len(v3)>0),
vs as (select *, list_transform(regexp_extract_all({_JOIN_NUMBERS('x')},{lit(_VALUE)}), lambda q: regexp_replace(trim(regexp_replace(q,'\\s+',' ','g')),'\\s*%\\s*$','%')) v from tx),
rp as (select *, list_position(list_transform(c, lambda y: coalesce(y.field,'')),'iss_rate') r, list_position(list_transform(v, lambda q: right(q,1)='%'),true) mk from vs where len(v)>0),
kp as (select *, case when coalesce(r,0)>0 then case when coalesce(mk,0)>0 then mk when r<=len(v) and {_RATE_LIKE('v[r]')} then r end end k from rp),
sd as (select *, case when k is null then c else c[1:r-1] end lc, case when k is null then {_AMOUNTS('v')} else {_AMOUNTS('v[1:k-1]')} end lm, case when k is null then [] else c[r+1:] end rc, case when k is null then [] else {_AMOUNTS('v[k+1:]')} end rm from kp),
mp as (select *, {_side_sql('lc', 'lm')} a1, case when k is not null and {_RATE_LIKE('v[k]')} then [{{'f':'iss_rate','v':v[k],'l':c[r].label}}] else [] end a2, {_side_sql('rc', 'rm')} a3 from sd),
m2 as (select *, a1 || a2 || a3 al from mp),
m3 as (select document_id, engine_id, line_index, al || case when len(list_filter(al, lambda q: q.f='iss_amount'))>0 then [] when k is not null then case when len(rm)>0 then [{{'f':'iss_amount','v':rm[1],'l':'valor iss'}}] else [] end when len(list_filter(c, lambda y: y.field='taxable_amount'))>0 and len({_AMOUNTS('v')})>len(c) then [{{'f':'iss_amount','v':{_AMOUNTS('v')}[-1],'l':'valor iss'}}] else [] end al from m2),
fl as (select document_id, engine_id, line_index, list_filter(al, lambda q, i: list_position(list_transform(al, lambda z: z.f), q.f)=i) al from m3),
un as (select document_id, engine_id, line_index, generate_subscripts(al,1)-1 as pos, unnest(al) q from fl)
select document_id, engine_id, line_index, cast(pos as int) as no, q.f as field, q.v as value, q.l as label from un""")
def value_table_map(s, sf):
    d = fintable.next_of(_classified(s, sf).select("document_id", "engine_id", "line_index", "text", "section", "n_lines"))
    t = fintable.tables(lines.with_next(d, 3, ["section", "normal", "text", "has_columns"]))
    return generate.kept(t, F.size("mapped") > 0).select("document_id", "engine_id", "line_index", F.posexplode("mapped").alias("no", "m")).select("document_id", "engine_id", "line_index", "no", "m.*")


@query(rf"""with {EL}, t as (select distinct text v from el where text is not null), u as (select v, {ascii_('v')} x from t),
w as (select v, x, regexp_extract(x,'^((?s:.)*?)(?:\b\d{{2}}/\d{{2}}/\d{{4}}\b|\b\d{{2}}/\d{{4}}\b|\b\d{{2}}[.,]\d{{3}}\.\d{{3}}/\d{{4}}-\d{{2}}\b|\b\d{{3}}\.\d{{3}}\.\d{{3}}-\d{{2}}\b|R\$\s*\d|\b\d{{1,3}}(?:\.\d{{3}})+,\d{{2}}\b|\b\d{{5}}-\d{{3}}\b|\b\d{{4,}}\b)',1) h from u)
select v as text, case when h<>'' and regexp_matches(substr(v,1,length(h)),'\p{{L}}') then regexp_replace(substr(v,1,length(h)),'^{SPACE}+|{SPACE}+$','','g') else v end as label, case when h<>'' and regexp_matches(substr(v,1,length(h)),'\p{{L}}') then regexp_replace(substr(v,length(h)+1),'^{SPACE}+|{SPACE}+$','','g') end as value from w""")
def typed_value_split(s, sf):
    v = S.elements(s, sf, "text").filter("text is not null").select("text").distinct()
    p = layout.typed_split(F.col("text"))
    return v.select("text", F.get(p, F.lit(0)).alias("label"), F.get(p, F.lit(1)).alias("value"))


@query(f"with {EL} select artifact_id, bounding_box.x x1, bounding_box.y y1, bounding_box.x+bounding_box.w x2, bounding_box.y+bounding_box.h y2, element_type as label from el where bounding_box.x is not null and bounding_box.y is not null and bounding_box.w is not null and bounding_box.h is not null and trim(element_type)<>''")
def layout_strings(s, sf):
    e = S.elements(s, sf, "bounding_box", "element_type").filter("bounding_box.x is not null and bounding_box.y is not null and bounding_box.w is not null and bounding_box.h is not null and trim(element_type) <> ''")
    b = F.col("bounding_box")
    num = lambda c: F.format_string("%.4f", c)
    text = F.concat(F.lit("["), F.concat_ws(",", num(b.x), num(b.y), num(b.x + b.w), num(b.y + b.h)), F.lit("]["), F.trim("element_type"), F.lit("][tag][PAIR_SEP] noise [RELATION_SEP]"))
    r = layout.layout_items(e.select("artifact_id", text.alias("layout")), "artifact_id", "layout")
    return r.select("artifact_id", *[F.round(c, 4).alias(c) for c in ("x1", "y1", "x2", "y2")], "label")


@query(f"""with w as (select unnest(range(20,6000,13)) w), t as (select w, cast((w*7)%4001+20 as int) h from w), a as (select w, h, case when greatest(w,h)>1280 then case when w>=h then 1280 else cast(trunc(w*1280/h) as int) end else w end w1, case when greatest(w,h)>1280 then case when w>=h then cast(trunc(h*1280/w) as int) else 1280 end else h end h1 from t)
select cast(w as int) w, h, cast(case when least(w1,h1)<28 then case when w1<=h1 then 28 else trunc(w1*28/h1) end else w1 end as int) new_w, cast(case when least(w1,h1)<28 then case when w1<=h1 then trunc(h1*28/w1) else 28 end else h1 end as int) new_h from a""")
def page_resize(s, sf):
    d = s.range(20, 6000, 13).select(F.col("id").cast("int").alias("w"), ((F.col("id") * 7) % 4001 + 20).cast("int").alias("h"))
    return d.select("w", "h", layout.resized(F.col("w"), F.col("h")).alias("r")).select("w", "h", F.col("r.w").alias("new_w"), F.col("r.h").alias("new_h"))


@query(f"with {EL} select artifact_id, text from el where text is not null union all select -artifact_id, text from el where text is not null and artifact_id%4 in (1,2)")
def payload_forms(s, sf):
    e = S.elements(s, sf, "text").filter("text is not null")
    k = F.pmod("artifact_id", F.lit(4))
    one = F.struct(F.col("text"))
    form = F.when(k == 0, F.to_json(one)).when(k == 1, F.to_json(F.array(one, one))).when(k == 2, F.to_json(F.struct(F.struct(F.array(one, one).alias("items")).alias("x"), F.array(one, one).alias("elements")))).otherwise(F.to_json(F.struct(F.array(one).alias("tokens"))))
    r = S.json_elements(S.payload_items(e.select("artifact_id", form.alias("payload"))), "item")
    return r.select(F.when(F.col("item_no") == 0, F.col("artifact_id")).otherwise(-F.col("artifact_id")).alias("artifact_id"), "text")


# ---- resolution and quality --------------------------------------------------------------------


def _score_case() -> str:
    w = D.WEIGHTS
    total = resolve.TOTAL
    arms = []
    for name, (cat, _, _) in D.FIELDS.items():
        al = ",".join(f"'{a}'" for a in sorted({name, *[" ".join(a.lower().split()) for a in D.ALIASES.get(name, [])]}))
        pat = "case when " + " or ".join(f"regexp_matches(v,{lit(p)})" for p in D.PATTERNS[name]) + " then 1.0 else 0.0 end" if name in D.PATTERNS else "0.0"
        kw = D.SECTION_KEYWORDS[cat]
        sec = "case when " + " or ".join(f"contains(section,'{k}')" for k in kw) + " then 1.0 when " + " or ".join(f"contains(context,'{k}')" for k in kw) + " then 0.5 else 0.0 end"
        conf = {"provider": "contains(section,'tomador')", "recipient": "contains(section,'prestador')"}.get(cat, "false")
        t = f"(case when f in ({al}) or label in ({al}) then 1.0 when context in ({al}) then 0.7 else 0.0 end)*{w['alias']}+({pat})*{w['pattern']}+pos*{w['positional']}+({sec})*{w['section']}+coalesce(confidence,0)*{w['engine']}-(case when {conf} then {w['conflict']} else 0.0 end)"
        arms.append(f"{{'field_name':'{name}','score':greatest(least(cast({t} as double)/{total},1.0),0.0)}}")
    return "[" + ",".join(arms) + "]"


_SCORES = f"""{CA}, c as (select document_id, engine_id, cand_id, candidate_ordinal, confidence, value, {ascii_('coalesce(value,' + lit('') + ')')} v, {squash_('field_name')} f, {squash_('label_text')} label, {squash_('section_name')} section, {squash_('context_text')} context,
case when coalesce(same_block_as_label,false) or coalesce(block_num=label_block_num,false) then 0.75 else 0.0 end pos from ca),
sx as (select document_id, engine_id, cand_id, candidate_ordinal, confidence, value, unnest({_score_case()}) u from c), sc as (select document_id, engine_id, cand_id, candidate_ordinal, confidence, value, u.field_name, u.score from sx where u.score>0)"""


@query(f"with {_SCORES} select cand_id, field_name, round(score,6) as score from sc")
def resolve_cross_score(s, sf):
    return resolve.scored(S.candidates(s, sf, "document_id", "engine_id", "field_name", "value", "confidence", "candidate_ordinal", "label_text", "section_name", "context_text", "same_block_as_label", "block_num", "label_block_num")).select("cand_id", "field_name", F.round("score", 6).alias("score"))


_RESOLVED = f"""{_SCORES}, k as (select *, row_number() over w rn, lead(score) over w s2, lead(coalesce(confidence,0)) over w c2, count(*) over (partition by document_id, engine_id, field_name) n from sc window w as (partition by document_id, engine_id, field_name order by round(score,9) desc, candidate_ordinal, cand_id)),
bf as (select document_id, engine_id, field_name, cand_id as selected_id, case when not (coalesce(abs(score-s2)<=0.1 and abs(coalesce(confidence,0)-c2)<=0.1,false) or score<0.6) then value end as value,
case when coalesce(abs(score-s2)<=0.1 and abs(coalesce(confidence,0)-c2)<=0.1,false) or score<0.6 then 'conflict' else 'resolved' end as status, score as confidence, n as n_candidates from k where rn=1)"""


@query(f"with {_RESOLVED} select document_id, engine_id, field_name, selected_id, value, status, round(confidence,6) as confidence, n_candidates from bf")
def resolve_fields(s, sf):
    r = resolve.resolved(resolve.scored(S.candidates(s, sf, "document_id", "engine_id", "field_name", "value", "confidence", "candidate_ordinal", "label_text", "section_name", "context_text", "same_block_as_label", "block_num", "label_block_num")), count=True)
    return r.select("document_id", "engine_id", "field_name", "selected_id", "value", "status", F.round("confidence", 6).alias("confidence"), "n_candidates")


@query(f"with {_SCORES} select document_id, engine_id, field_name, cast(row_number() over (partition by document_id, engine_id, field_name order by round(score,9) desc, candidate_ordinal, cand_id) as int) as place, cand_id, round(score,6) as score from sc")
def resolve_alternatives(s, sf):
    r = resolve.places(resolve.scored(S.candidates(s, sf, "document_id", "engine_id", "field_name", "value", "confidence", "candidate_ordinal", "label_text", "section_name", "context_text", "same_block_as_label", "block_num", "label_block_num")))
    return r.select("document_id", "engine_id", "field_name", "place", "cand_id", F.round("score", 6).alias("score"))


def _evidence_case() -> str:
    arms = []
    for name, (cat, _, _) in D.FIELDS.items():
        al = ",".join(f"'{a}'" for a in sorted({name, *[" ".join(a.lower().split()) for a in D.ALIASES.get(name, [])]}))
        pat = "case when " + " or ".join(f"regexp_matches(v,{lit(p)})" for p in D.PATTERNS[name]) + " then 1.0 else 0.0 end" if name in D.PATTERNS else "0.0"
        kw = D.SECTION_KEYWORDS[cat]
        sec = "case when " + " or ".join(f"contains(section,'{k}')" for k in kw) + " then 1.0 when " + " or ".join(f"contains(context,'{k}')" for k in kw) + " then 0.5 else 0.0 end"
        conf = {"provider": "contains(section,'tomador')", "recipient": "contains(section,'prestador')"}.get(cat, "false")
        arms.append(f"{{'field_name':'{name}','a':cast(case when f in ({al}) or label in ({al}) then 1.0 when context in ({al}) then 0.7 else 0.0 end as double),'p':cast({pat} as double),'s':cast({sec} as double),'c':{conf}}}")
    return "[" + ",".join(arms) + "]"


@query(f"with {_SCORES}, ev as (select cand_id, cast(pos as double) pos, unnest({_evidence_case()}) u from c) select ev.cand_id, u.field_name as field_name, u.a as alias_match, u.p as pattern_match, pos as positional_match, u.s as section_match, u.c as section_conflict from ev join sc on sc.cand_id=ev.cand_id and sc.field_name=u.field_name")
def resolve_evidence(s, sf):
    r = resolve.scored(S.candidates(s, sf, "document_id", "engine_id", "field_name", "value", "confidence", "candidate_ordinal", "label_text", "section_name", "context_text", "same_block_as_label", "block_num", "label_block_num"), evidence=True)
    return r.select("cand_id", "field_name", *resolve.EVIDENCE)


def resolved_fields(s: SparkSession, sf: str) -> DataFrame:
    """The resolved fields of every document and engine, as all later steps take them."""
    return resolve.resolved(resolve.scored(S.candidates(s, sf, "document_id", "engine_id", "field_name", "value", "confidence", "candidate_ordinal", "label_text", "section_name", "context_text", "same_block_as_label", "block_num", "label_block_num"))).select("document_id", "engine_id", "field_name", "value", "status", "confidence")


_REQ = ",".join(f"('{f}')" for f, (_, _, r) in D.FIELDS.items() if r)


@query(f"with {_RESOLVED} select d.document_id, d.engine_id, r.field_name from (select distinct document_id, engine_id from bf) d cross join (values {_REQ}) r(field_name) where not exists (select 1 from bf where bf.document_id is not distinct from d.document_id and bf.engine_id is not distinct from d.engine_id and bf.field_name=r.field_name and bf.value is not null and trim(bf.value)<>'')")
def required_missing(s, sf):
    f = resolved_fields(s, sf)
    return quality.missing_fields(f, f, ["document_id", "engine_id"], quality.dictionary(s))


def _issue_sql() -> str:
    kind = "case field_name " + " ".join(f"when '{f}' then '{t}'" for f, (_, t, _r) in D.FIELDS.items()) + " end"
    dt = "case when regexp_matches(trim(value),'^\\d{1,2}/\\d{1,2}/\\d{4}$') then cast(try_strptime(trim(value),'%d/%m/%Y') as date) when regexp_matches(trim(value),'^\\d{4}-\\d{1,2}-\\d{1,2}$') then cast(try_strptime(trim(value),'%Y-%m-%d') as date) when regexp_matches(trim(value),'^\\d{1,2}/\\d{4}$') then cast(try_strptime('1/'||trim(value),'%d/%m/%Y') as date) end"
    rules = [
        (f"k='document_id' and not ({_valid_sql('value')})", "invalid_document_id"), ("k='date' and d is null", "invalid_date_format"), (f"k='date' and d>date '{AS_OF}'", "implausible_future_date"), ("k='date' and year(d)<2000", "implausible_historic_date"),
        ("k='decimal' and m is null", "invalid_monetary_value"), ("k='decimal' and m<0", "negative_monetary_value"), ("k='percentage' and p is null", "invalid_percentage"), ("k='percentage' and (p<0 or p>100)", "implausible_percentage"),
        ("field_name='service_code' and not regexp_matches(value,'^\\d{1,4}(\\.\\d{1,2})?$')", "invalid_service_code"), ("field_name like '%\\_email' escape '\\' and not regexp_matches(value,'^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')", "invalid_email"),
        ("field_name like '%\\_phone' escape '\\' and length(regexp_replace(value,'[^0-9]','','g')) not between 10 and 13", "invalid_phone"), (f"field_name like '%\\_uf' escape '\\' and upper(trim(value)) not in ({','.join(lit(u) for u in D.UFS)})", "invalid_uf"),
    ]
    codes = "[" + ",".join(f"case when {c} then '{n}' end" for c, n in rules) + "]"
    return f"with {_RESOLVED}, x as (select *, {kind} k, {dt} d, {_decimal_sql('value')} m, {_decimal_sql(chr(114) + 'eplace(value,' + lit('%') + ',' + lit('') + ')')} p from bf where status='resolved' and value is not null and trim(value)<>''), y as (select document_id, engine_id, field_name, unnest({codes}) code from x) select * from y where code is not null"


@query(_issue_sql())
def field_value_issues(s, sf):
    return quality.issues(resolved_fields(s, sf), ["document_id", "engine_id"], AS_OF)


_CORR = """co as (select document_id, field_name, max_by(corrected_value, (coalesce(epoch(coalesce(try_strptime(reviewed_at,'%Y-%m-%d %H:%M:%S'),try_strptime(reviewed_at,'%Y-%m-%dT%H:%M:%S'),try_strptime(reviewed_at,'%Y-%m-%d'),try_strptime(reviewed_at,'%d/%m/%Y %H:%M'),try_strptime(reviewed_at,'%d/%m/%Y'))),0), corrected_value)) as corrected_value
 from corrections where corrected_value is not null and trim(corrected_value)<>'' group by all)"""


@query(f"with {_CORR} select * from co")
def last_corrections(s, sf):
    return quality.last_corrections(S.table(s, sf, "corrections"))


@query(f"""with {_RESOLVED}, {_CORR}, b as (select document_id, field_name, value, confidence, status from bf where engine_id='tesseract')
select coalesce(b.document_id,co.document_id) document_id, coalesce(b.field_name,co.field_name) field_name, coalesce(corrected_value,value) as value, case when corrected_value is not null then 'resolved' else status end as status, case when corrected_value is null then round(confidence,6) end as confidence, case when corrected_value is not null then value end as previous_value from b full join co on b.document_id=co.document_id and b.field_name=co.field_name""")
def apply_corrections(s, sf):
    f = resolved_fields(s, sf).filter("engine_id = 'tesseract'").drop("engine_id").withColumn("confidence", F.round("confidence", 6))
    return quality.corrected(f, quality.last_corrections(S.table(s, sf, "corrections")))


def _validation_sql() -> str:
    """All checks: missing, by field (the first finding of the state ends it), between fields."""
    required = ",".join(f"'{f}'" for f, (_, _, r) in D.FIELDS.items() if r)
    kind = "case field_name " + " ".join(f"when '{f}' then '{t}'" for f, (_, t, _r) in D.FIELDS.items()) + " end"
    dt = "case when regexp_matches(v,'^\\d{1,2}/\\d{1,2}/\\d{4}$') then cast(try_strptime(v,'%d/%m/%Y') as date) when regexp_matches(v,'^\\d{4}-\\d{1,2}-\\d{1,2}$') then cast(try_strptime(v,'%Y-%m-%d') as date) when regexp_matches(v,'^\\d{1,2}/\\d{4}$') then cast(try_strptime('1/'||v,'%d/%m/%Y') as date) end"
    own = "case when req then 'error' else 'warning' end"
    rules = [
        (f"k='document_id' and not ({_valid_sql('v')})", "invalid_document_id", own, 4), ("field_name like '%\\_email' escape '\\' and not regexp_matches(v,'^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')", "invalid_email", "'warning'", 5),
        ("field_name like '%\\_phone' escape '\\' and length(regexp_replace(v,'[^0-9]','','g')) not between 10 and 13", "invalid_phone", "'warning'", 6), (f"field_name like '%\\_uf' escape '\\' and upper(trim(v)) not in ({','.join(lit(u) for u in D.UFS)})", "invalid_uf", "'warning'", 7),
        ("k='date' and d is null", "invalid_date_format", "'error'", 8), (f"k='date' and d>date '{AS_OF}'", "implausible_future_date", "'warning'", 9), ("k='date' and year(d)<2000", "implausible_historic_date", "'warning'", 10),
        ("field_name='service_code' and not regexp_matches(v,'^\\d{1,4}(\\.\\d{1,2})?$')", "invalid_service_code", "'warning'", 11), ("k='decimal' and m is null", "invalid_monetary_value", own, 12), ("k='decimal' and m<0", "negative_monetary_value", own, 13),
        ("k='percentage' and p is null", "invalid_percentage", "'warning'", 14), ("k='percentage' and (p<0 or p>100)", "implausible_percentage", "'warning'", 15),
    ]
    found = "[" + ",".join(f"case when {c} then {{'code':'{n}','severity':{sv},'o':{o}}} end" for c, n, sv, o in rules) + "]"
    return f"""with {_RESOLVED}, t as (select *, trim(value) v, field_name in ({required}) req, {kind} k from bf), u as (select *, {dt} d, {_decimal_sql('v')} m, {_decimal_sql("replace(v,'%','')")} p from t),
y as (select document_id, engine_id, field_name, case when status='conflict' then [{{'code':'field_conflict','severity':{own},'o':1}}] when req and (value is null or v='') then [{{'code':'required_field_unresolved','severity':'error','o':2}}] when value is not null and v<>'' then {found} end c from u),
z as (select document_id, engine_id, field_name, unnest(c) e from y),
rq as (select unnest([{required}]) field_name),
every as (select document_id, engine_id, field_name, e.code code, e.severity severity, 1 b, e.o o from z where e is not null
 union all select d.document_id, d.engine_id, rq.field_name, 'required_field_missing', 'error', 0, 0 from (select distinct document_id, engine_id from bf) d cross join rq where not exists (select 1 from bf where bf.document_id is not distinct from d.document_id and bf.engine_id is not distinct from d.engine_id and bf.field_name=rq.field_name)
 union all select document_id, engine_id, 'recipient_document', 'provider_recipient_document_equal', 'warning', 2, 16 from (select document_id, engine_id, max(case when field_name='provider_document' and status='resolved' then nullif(regexp_replace(value,'[^0-9]','','g'),'') end) pd, max(case when field_name='recipient_document' and status='resolved' then nullif(regexp_replace(value,'[^0-9]','','g'),'') end) rd from bf group by all) where pd=rd)"""


@query(_validation_sql() + " select document_id, engine_id, b||':'||field_name||':'||lpad(cast(o as varchar),2,'0') as rule_order, field_name, code, severity from every")
def validation_issues(s, sf):
    return quality.validation(resolved_fields(s, sf), ["document_id", "engine_id"], AS_OF).drop("message")


@query(_validation_sql() + """, f as (select document_id, engine_id, count(*) filter (status='resolved') resolved, count(*) filter (status='missing') missing, count(*) filter (status='conflict') conflict from bf group by all),
i as (select document_id, engine_id, count(*) filter (severity='info') info, count(*) filter (severity='warning') warning, count(*) filter (severity='error') error from every group by all)
select f.*, coalesce(info,0) info, coalesce(warning,0) warning, coalesce(error,0) error, case when coalesce(error,0)>0 then 'error' when conflict>0 then 'conflict' else 'processed' end document_status from f left join i on f.document_id is not distinct from i.document_id and f.engine_id is not distinct from i.engine_id""")
def document_summary(s, sf):
    f = resolved_fields(s, sf)
    return report.document_summary(f, quality.validation(f, ["document_id", "engine_id"], AS_OF))


@query(_validation_sql() + """, a as (select document_id, engine_id, field_name, case when status='resolved' and value is not null and confidence<0.6 then 1 else 0 end l, case when status='conflict' then 1 else 0 end c, 0 i from bf union all select document_id, engine_id, field_name, 0, 0, 1 from every)
select document_id, engine_id, sum(l)::bigint low_confidence_fields, sum(c)::bigint conflicts, sum(i)::bigint validation_issues, string_agg(distinct field_name, ',' order by field_name) filter (l+c+i>0) review_candidates, count(*) filter (l+c+i>0)>0 review_required from a group by all""")
def manual_review_sheet(s, sf):
    f = resolved_fields(s, sf)
    r = report.review_sheet(f, quality.validation(f, ["document_id", "engine_id"], AS_OF)).drop("corrections_template")
    return r.withColumn("review_candidates", F.nullif(F.array_join("review_candidates", ","), F.lit("")))


_CRIT = ",".join(f"'{f}'" for f in D.CRITICAL)


@query(f"""with {_RESOLVED}, g as (select document_id, engine_id, count(*) filter (field_name in ({_CRIT}) and status='resolved' and value is not null and trim(value)<>'')/9.0 coverage, avg(confidence) filter (status='resolved' and value is not null and trim(value)<>'') average_confidence from bf group by all),
cs as (select document_id, max(least(greatest(completeness_score,0.0),1.0)) completeness from source_documents where completeness_score is not null group by all)
select document_id, engine_id, round(coverage+1e-9,4) coverage, round(average_confidence+1e-9,4) average_confidence, round(completeness+1e-9,4) completeness, round((coverage+coalesce(average_confidence,0)+coalesce(completeness,0))/(1+case when average_confidence is null then 0 else 1 end+case when completeness is null then 0 else 1 end)+1e-9,4) score from g left join cs using (document_id)""")
def document_scores(s, sf):
    done = S.table(s, sf, "source_documents").filter("completeness_score is not null").select("document_id", F.col("completeness_score").alias("completeness"))
    r = report.document_scores(resolved_fields(s, sf), done)
    return r.select("document_id", "engine_id", *[F.round(F.col(c) + 1e-9, 4).alias(c) for c in ("coverage", "average_confidence", "completeness", "score")])


_ORDER = "(values " + ",".join(f"({i},'{f}','{c}',{str(f in D.CRITICAL).lower()})" for i, (f, (c, _, _r)) in enumerate(D.FIELDS.items())) + ") o(place, field_name, category, critical)"


@query(f"with {_RESOLVED} select document_id, engine_id, cast(place as int) place, category, field_name, critical, value, status from bf join {_ORDER} using (field_name)")
def detail_view(s, sf):
    return report.detail(resolved_fields(s, sf))


# ---- experiments and reports -------------------------------------------------------------------

_EXP = "ex as (select document_id, field_name, max(expected_value) expected_value from expected_values where expected_value is not null group by all)"
_FILLED = "status='resolved' and value is not null and trim(value)<>''"


@query(f"""with {_RESOLVED}, {_EXP}, dn as (select engine_id, count(distinct document_id) documents from bf group by all),
j as (select bf.*, expected_value from bf left join ex using (document_id, field_name)),
sm as (select engine_id, field_name, count(*) filter ({_FILLED}) n_filled, count(*) filter (status='conflict') n_conflict, count(*) filter (expected_value is not null) n_evaluated, count(*) filter (expected_value is not null and {_FILLED} and {n_('value')}={n_('expected_value')}) n_correct from j group by all)
select dn.engine_id, f.field_name, documents, coalesce(n_filled,0) n_filled, coalesce(n_conflict,0) n_conflict, coalesce(n_evaluated,0) n_evaluated, coalesce(n_correct,0) n_correct, round(coalesce(n_filled,0)/greatest(documents,1),6) fill_rate, round(coalesce(n_conflict,0)/greatest(documents,1),6) conflict_rate, round(coalesce(n_correct,0)/nullif(n_evaluated,0),6) correctness_rate
from dn cross join (values {",".join(f"('{f}')" for f in D.FIELDS)}) f(field_name) left join sm using (engine_id, field_name)""")
def experiment_field_metrics(s, sf):
    f = resolved_fields(s, sf)
    x = S.table(s, sf, "expected_values").filter("expected_value is not null").groupBy("document_id", "field_name").agg(F.max("expected_value").alias("expected_value"))
    m = E.field_metrics(f, f.select("engine_id", "document_id"), x, lambda a, b: T.norm(a) == T.norm(b))
    return m.withColumns({c: F.round(c, 6) for c in ("fill_rate", "conflict_rate", "correctness_rate")})


@query(f"with {_RESOLVED} select engine_id, document_id, round(count(*) filter ({_FILLED})/{len(D.FIELDS)}.0,6) as fill_rate, count(*) filter (status='conflict') as conflicts from bf group by all")
def document_fill_rate(s, sf):
    return E.document_fill(resolved_fields(s, sf)).withColumn("fill_rate", F.round("fill_rate", 6))


@query(_validation_sql() + """, f as (select document_id, engine_id, count(*) filter (status='resolved') resolved, count(*) filter (status='conflict') conflict from bf group by all), i as (select document_id, engine_id, count(*) filter (severity='error') error from every group by all),
d as (select f.engine_id, resolved, case when coalesce(error,0)>0 then 'error' when conflict>0 then 'conflict' else 'processed' end st from f left join i on f.document_id is not distinct from i.document_id and f.engine_id is not distinct from i.engine_id)
select engine_id, count(*) documents, round(avg(resolved),6) average_resolved, round(avg(case when st<>'processed' then 1.0 else 0.0 end),6) review_rate, count(*) filter (st='error') documents_error, count(*) filter (st='conflict') documents_conflict, count(*) filter (st='processed') documents_processed from d group by all""")
def experiment_engine_summary(s, sf):
    f = resolved_fields(s, sf)
    r = report.engine_summary(f, report.document_summary(f, quality.validation(f, ["document_id", "engine_id"], AS_OF)))
    return r.withColumns({c: F.round(c, 6) for c in ("average_resolved", "review_rate")})


@query(f"with {CA} select engine_id, field_name, count(*) as n, round(avg(confidence),6) as mean from ca group by grouping sets ((engine_id, field_name),(engine_id),())")
def experiment_rollup(s, sf):
    return S.candidates(s, sf, "engine_id", "field_name", "confidence").rollup("engine_id", "field_name").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 6).alias("mean"))


_HAS = ", ".join(f"max(case when field_name='{f}' and value is not null and trim(value)<>'' then 1 else 0 end) as has_{f}" for f in D.CRITICAL)


@query(f"with {_RESOLVED}, h as (select engine_id, document_id, {_HAS} from bf group by all) select *, round(({'+'.join('has_' + f for f in D.CRITICAL)})/9.0,6) as coverage, ({'+'.join('has_' + f for f in D.CRITICAL)})||'/9' as found from h")
def critical_coverage_pivot(s, sf):
    c = E.critical_coverage(resolved_fields(s, sf))
    n = sum((F.col(f"has_{f}") for f in D.CRITICAL), F.lit(0))
    return c.withColumn("coverage", F.round("coverage", 6)).withColumn("found", F.concat(n.cast("string"), F.lit(f"/{len(D.CRITICAL)}")))


@query(f"with {CA} select field_name, count(*) as n, count(*) filter (review_status='needs_review') as needs_review from ca group by all")
def review_status_counts(s, sf):
    return S.candidates(s, sf, "field_name", "review_status").groupBy("field_name").agg(F.count("*").alias("n"), F.count_if(F.col("review_status") == "needs_review").alias("needs_review"))


@query(f"with {CA} select cand_id, document_id, field_name, value, confidence from ca where confidence is not null order by confidence desc, cand_id limit 25")
def topk_candidates(s, sf):
    return S.candidates(s, sf, "document_id", "field_name", "value", "confidence").filter("confidence is not null").orderBy(F.desc("confidence"), "cand_id").limit(25).select("cand_id", "document_id", "field_name", "value", "confidence")


@query(f"with {CA}, r as (select document_id, engine_id, field_name, cand_id, confidence, row_number() over (partition by document_id, engine_id, field_name order by confidence desc nulls last, cand_id) as place from ca) select document_id, engine_id, field_name, cand_id, cast(place as int) as place from r where place<=3")
def topk_per_field(s, sf):
    w = Window.partitionBy("document_id", "engine_id", "field_name").orderBy(F.desc_nulls_last("confidence"), "cand_id")
    return S.candidates(s, sf, "document_id", "engine_id", "field_name", "confidence").withColumn("place", F.row_number().over(w)).filter("place <= 3").select("document_id", "engine_id", "field_name", "cand_id", "place")


#: A configuration with faults of every kind, for the query below.
_FAULTY = (["a", "b", "c"], {"a": ["x", "y"], "b": ["y"], "d": ["z"]}, {"a": ["."], "e": ["."]}, ["a", "f"], {"good": 0.5, "below": -0.1}, {"share": 0.5, "above": 1.5, "maximum_warnings": 3.0, "maximum_errors": -1.0, "maximum_part": 0.5})


@query("""with field(name) as (values ('a'),('b'),('c')), alias(field, label) as (values ('a','x'),('a','y'),('b','y'),('d','z')), pattern(name) as (values ('a'),('e')), crit(name) as (values ('a'),('f')), weight(name, v) as (values ('good',0.5),('below',-0.1)), threshold(name, v) as (values ('share',0.5),('above',1.5),('maximum_warnings',3.0),('maximum_errors',-1.0),('maximum_part',0.5))
select 'unknown_alias_field' as kind, field as name, '' as detail from alias where field not in (select name from field) union all select 'unknown_pattern_field', name, '' from pattern where name not in (select name from field) union all select 'unknown_critical_field', name, '' from crit where name not in (select name from field)
union all select 'alias_collision', label, string_agg(distinct field, ',' order by field) from alias group by label having count(distinct field)>1 union all select 'bad_weight', name, cast(cast(v as double) as varchar) from weight where v<0
union all select 'bad_threshold', name, cast(cast(v as double) as varchar) from threshold where v<0 or (not starts_with(name,'maximum') and v>1) or (starts_with(name,'maximum') and v<>floor(v))""")
def config_integrity(s, sf):
    return integrity.problems(s, *_FAULTY)


@query("select cast(0 as bigint) as problems from region limit 1")
def config_sound(s, sf):
    c = D.DEFAULT
    weights = {k: v for k, v in c.weights.items()}
    return integrity.problems(s, list(c.fields), c.extra_labels, c.patterns, c.critical, weights, c.thresholds).agg(F.count("*").alias("problems"))


@query("select date_trunc('hour',ts) as start, event_type, count(*) as n, round(sum(value),4) as total from events group by 1,2 having date_trunc('hour',min(ts))+interval 1 hour <= (select max(ts)-interval 2 day from events)")
def stream_throughput(s, sf):
    at = f"{shared_dir(s)}/stream-{uuid.uuid4().hex}"
    schema = S.table(s, sf, "events").schema
    events = s.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    out = streams.throughput(events.withColumn("ts", F.col("ts").cast("timestamp")))
    streams.run_once(out, f"{at}/out", f"{at}/state")
    r = s.read.schema("start timestamp, event_type string, n long, total double").parquet(f"{at}/out")
    return r.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query(f"""with {_RESOLVED}, {_EXP}, j as (select bf.*, expected_value from bf left join ex using (document_id, field_name)),
sm as (select engine_id, field_name, count(*) filter ({_FILLED}) n_filled, count(*) filter (status='conflict') n_conflict, count(*) filter (expected_value is not null) n_evaluated from j group by all)
select engine_id, field_name from sm where n_filled>0 or n_conflict>0 or n_evaluated>0""")
def report_fields(s, sf):
    x = S.table(s, sf, "expected_values").filter("expected_value is not null").groupBy("document_id", "field_name").agg(F.max("expected_value").alias("expected_value"))
    f = resolved_fields(s, sf)
    m = E.field_metrics(f, f.select("engine_id", "document_id"), x, lambda a, b: T.norm(a) == T.norm(b))
    return report.report_lines(m).select("engine_id", F.trim(F.substring("line", 1, 32)).alias("field_name"))


@query("select count(*) n, count(distinct document_id) documents, sum(case when review_status='needs_review' and field_name in ('nfse_number','issue_date','net_amount') then 1 else 0 end)::bigint important_to_review from (select * from candidates qualify row_number() over (partition by cand_id order by loaded_at desc)=1)")
def review_overview(s, sf):
    c = S.candidates(s, sf, "document_id", "field_name", "review_status")
    return c.agg(F.count("*").alias("n"), F.countDistinct("document_id").alias("documents"), F.count_if((F.col("review_status") == "needs_review") & F.col("field_name").isin("nfse_number", "issue_date", "net_amount")).alias("important_to_review"))


@query("with d as (select distinct document_id from source_documents where document_id is not null), e as (select distinct engine_id from raw_artifacts where engine_id is not null), p as (select distinct document_id, engine_id from raw_artifacts) select d.document_id, e.engine_id, p.document_id is not null as processed from d cross join e left join p on p.document_id=d.document_id and p.engine_id=e.engine_id")
def experiment_grid(s, sf):
    """Every document with every engine, and whether the engine has read it."""
    a = S.table(s, sf, "raw_artifacts").select("document_id", "engine_id").distinct()
    return E.grid(S.table(s, sf, "source_documents").select("document_id"), a)


@query("with w as (select time_bucket(interval 30 minute, ts)-interval 30 minute*k as start, event_type, value from events, (values (0),(1)) x(k)) select start, event_type, count(*) n, round(sum(value),4) total from w group by all")
def sliding_throughput(s, sf):
    e = S.table(s, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    r = streams.throughput(e, slide="30 minutes")
    return r.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


def flagship(s: SparkSession, sf: str) -> DataFrame:
    """Which value of every field survives, and why others do not."""
    return resolve_fields(s, sf)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for n, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {n: q for n, (_, q) in QUERIES.items() if q}
