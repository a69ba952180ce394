"""SQL for the text operators' queries, where SQL can say what must hold."""

from __future__ import annotations

# Fixed values, as the Unicode standard has them: ranges of signs, and letters that look like Latin ones.
FULL = r"[\x{FF01}-\x{FF5E}\x{FFE0}-\x{FFE6}\x{3000}]"
MARK = r"[\x{0300}-\x{034E}\x{0350}-\x{036F}\x{1AB0}-\x{1ABF}\x{1DC0}-\x{1DFF}\x{20D0}-\x{20F0}]"
ZERO = r"[\x{00AD}\x{034F}\x{061C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FE00}-\x{FE0F}\x{FEFF}]"
SPACE = r"[\x{00A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}]"
ALIKE = "[ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹαικνορυχϲϳАВЕЅІЈКМНОРСТУХҺаеѕіјкорсухһԁԛԝӏ]"
LATIN = r"[A-Za-zªºÀ-ÖØ-öø-\x{024F}\x{1E00}-\x{1EFF}\x{FF21}-\x{FF3A}\x{FF41}-\x{FF5A}]"


def _forms() -> str:
    """The forms of a text t without invisible signs u: a word of look-alikes counts if it has Latin letters and none of the other script's own."""
    words = rf"regexp_extract_all(u,'(?:\p{{L}}|{MARK})+')"
    own = rf"list_filter(regexp_extract_all(%s,'[\x{{0370}}-\x{{052F}}]'), lambda c: regexp_matches(c,'\p{{L}}') and not regexp_matches(c,'{ALIKE}'))"
    around = f"regexp_matches(u,'{LATIN}') and len({own % 'u'})=0"
    word = f"len(list_filter({words}, lambda w: regexp_matches(w,'{ALIKE}') and regexp_matches(w,'{LATIN}') and len({own % 'w'})=0))>0"
    tests = {"full_width": f"regexp_matches(t,'{FULL}')", "combining": rf"regexp_matches(u,'(?:\p{{L}}|{MARK}){MARK}')", "zero_width": f"regexp_matches(t,'{ZERO}')", "odd_space": f"regexp_matches(t,'{SPACE}')", "look_alike": f"regexp_matches(u,'{ALIKE}') and (({around}) or {word})"}
    return "[" + ",".join(f"case when {c} then '{k}' end" for k, c in tests.items()) + "]"


def _last(name: str, key: str, field: str) -> str:
    return f"select '{name}' as source_table, {key} as row_key, '{field}' as field_name, {field} t from {name} where {key} is not null qualify row_number() over (partition by {key} order by loaded_at desc nulls last)=1"


SQL = {
    "p4_found": f"""with r as ({_last("raw_artifacts", "artifact_id", "text")} union all {_last("candidates", "cand_id", "value")}), d as (select distinct t, regexp_replace(t,'{ZERO}','','g') u from r where t is not null and regexp_matches(t,'[^\\x00-\\x7F]')),
k as (select t, unnest({_forms()}) form_kind from d) select source_table, row_key, field_name, form_kind from r join k using (t) where form_kind is not null""",
    "p7_kept": "select limit_id, (select count(distinct doc_id) from documents where text is not null) as documents, cast(0 as bigint) as over_full, cast(0 as bigint) as split_needlessly from size_limits where purpose='pack'",
    "p9_rebuilt": r"select limit_id, doc_id, cast(length(x) as int) as n_chars, md5(x) as digest from (select limit_id, doc_id, regexp_replace(text,'[\s\x{85}\p{Z}\x0B\x1C-\x1F]+','','g') x from documents cross join size_limits where purpose='split' and text is not null)",
}
