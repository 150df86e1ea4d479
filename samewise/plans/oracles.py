"""DuckDB SQL for the registered queries, built from the same rules and word lists."""

from __future__ import annotations

from samewise.functions import text as t
from samewise.operators import blocking as B
from samewise.operators import evaluation as E
from samewise.operators.features import STRUCTURED
from samewise.plans.queries import LOW_CAPS, MATCH_AT


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _ascii(c: str) -> str:
    out = f"strip_accents({c})"
    for letter, plain in {**t.MULTIPLE, **t.SINGLE}.items():
        out = f"replace({out}, '{letter}', '{plain.replace(chr(39), chr(39) * 2)}')"
    return out


def _folded(c: str, rules) -> str:
    for pattern, word in rules:
        c = f"regexp_replace({c}, '{pattern}', '{word}', 'g')"
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


def _longest(tokens: str, most: int) -> str:
    placed = f"list_transform({tokens}, lambda x, i: {{'n': -length(x), 'i': i, 't': x}})"
    return f"list_transform(list_sort({placed}), lambda s: s.t)[1:{most}]"


_NAME = _folded(f"regexp_replace(regexp_replace(lower({_ascii("coalesce(business_name, '')")}), '^[-*<>~.\\s]+', ''), '[^a-z0-9&\\s]', ' ', 'g')", t.NAME_RULES)
_ADDRESS = _folded(f"regexp_replace(lower({_ascii("coalesce(business_address, '')")}), '[^a-z0-9\\s,]', ' ', 'g')", t.ADDRESS_RULES)
_TOKENS = "list_filter(regexp_split_to_array({}, '\\s+'), lambda x: x <> '')"

BASE = f"""
doc as (select doc_id, lang, n_chars, text, trim(regexp_replace(text, '\\s+', ' ', 'g')) as t from documents),
word as (select *, string_split(t, ' ') as w, concat('S', cast(doc_id % 3 + 1 as varchar), '-', printf('%07d', doc_id)) as entity_id from doc),
raw as (
  select entity_id, concat(substr(t, 1, 40), case doc_id % 4 when 0 then ' Pvt. Ltd.' when 1 then ' & Co' else '' end) as business_name,
    case when doc_id % 11 = 0 then null else concat(cast(n_chars as varchar), ' ', coalesce(w[3], ''), ' Rd., ', coalesce(w[4], ''), ', ', cast(100000 + (n_chars * 7919) % 900000 as varchar)) end as business_address,
    case when doc_id % 29 = 0 then null else upper(lang) end as country
  from word),
clean as (select entity_id, country, {_NAME} as clean_name, {_ADDRESS} as clean_addr from raw),
core as (select *, array_to_string(list_filter(string_split(clean_name, ' '), lambda x: x not in ({_quoted(t.LEGAL_WORDS)})), ' ') as name_core from clean),
rec as (
  select *, lower(trim(coalesce(country, ''))) as country_norm, substr(regexp_replace(name_core, '[^a-z0-9]', '', 'g'), 1, 4) as name_key,
    regexp_extract(clean_addr, '{t.PIN}', 1) as pin, regexp_extract(clean_addr, '{t.HOUSE}', 1) as house_feat, regexp_extract(clean_addr, '{t.HOUSE_BLOCK}', 1) as house_no,
    coalesce(list_filter(list_transform(string_split(clean_addr, ','), lambda p: trim(p)), lambda p: length(p) >= 3 and not regexp_matches(p, '\\d'))[-1], '') as city,
    {_longest(f"list_filter(string_split(name_core, ' '), lambda x: length(x) >= 3 and x not in ({_quoted(t.GENERIC_NAME_WORDS)}))", 3)} as sig_tokens,
    {_longest(f"list_filter(string_split(regexp_replace(clean_addr, '[^a-z0-9\\s]', ' ', 'g'), ' '), lambda x: length(x) >= 4 and x not in ({_quoted(t.ADDRESS_STOPWORDS)}) and not regexp_matches(x, '^\\d+$'))", 2)} as addr_tokens,
    length(clean_name) as name_len, length(clean_addr) as addr_len, len({_TOKENS.format('clean_name')}) as name_tokens, len({_TOKENS.format('clean_addr')}) as addr_tokens_n
  from core),
truth as (
  select distinct a.entity_id as s1, b.entity_id as cid from word a join word b on a.text = b.text where a.entity_id like 'S1-%' and b.entity_id not like 'S1-%'),
keys as (
  select distinct entity_id, country, kind, key from (
    select entity_id, country, 'name_key' as kind, name_key as key from rec where name_key <> ''
    union all select entity_id, country, 'pin', pin from rec where pin <> ''
    union all select entity_id, country, 'token', unnest(sig_tokens) from rec
    union all select entity_id, country, 'house_street', house_no || '_' || a from (select *, unnest(addr_tokens) as a from rec) where house_no <> ''
    union all select entity_id, country, 'pin_house', pin || '_' || house_no from rec where pin <> '' and house_no <> ''
    union all select entity_id, country, 'addr_token', a from (select *, unnest(addr_tokens) as a from rec) where length(a) >= 5))"""


def _blocks(caps: dict[str, int] = B.CAPS) -> str:
    limit = " ".join(f"when '{k}' then {v}" for k, v in caps.items())
    return f"""{BASE},
ranked as (select *, row_number() over (partition by kind, country, key order by entity_id) as rn from keys where entity_id not like 'S1-%'),
hit as (
  select a.entity_id as s1, b.entity_id as cid, a.kind from keys a join ranked b on a.kind = b.kind and a.key = b.key and a.country is not distinct from b.country
  where a.entity_id like 'S1-%' and b.rn <= case b.kind {limit} end),
cand as (select distinct s1, cid from hit),
uni as (select entity_id as s1 from rec where entity_id like 'S1-%')"""


_SCORE = """case when a.name_core <> '' and a.name_core = b.name_core then 100 else 0 end
  + case when a.pin <> '' and a.pin = b.pin then 25 when length(a.pin) >= 3 and b.pin <> '' and starts_with(b.pin, substr(a.pin, 1, 3)) then 10 else 0 end
  + case when a.house_no <> '' and a.house_no = b.house_no then 25 else 0 end + case when list_has_any(a.addr_tokens, b.addr_tokens) then 20 else 0 end
  + case when list_has_any(a.sig_tokens, b.sig_tokens) then 20 else 0 end + case when a.name_key <> '' and starts_with(b.name_core, a.name_key) then 20 else 0 end"""


#: The longest common subsequence of each row (x, y) of texts: row by row of x, each row a fold over y.
_FOLD = """fold as (
  select x, y, 1 as i, list_transform(range(length(y) + 1), lambda z: cast(0 as bigint)) as r from texts
  union all
  select x, y, i + 1, list_reduce(range(1, length(y) + 1), lambda n, j: list_append(n, case when substr(x, i, 1) = substr(y, cast(j as int), 1) then r[j] + 1 else greatest(r[j + 1], n[-1]) end), [cast(0 as bigint)])
  from fold where i <= length(x)),
lcs as (select x, y, r[-1] as n from fold where i = length(x) + 1)"""


def _scored() -> str:
    """The rule's pieces: shortlist of 100, token-sort similarity of the cores, bonuses, top 20."""
    return f"""with recursive {_blocks().strip()},
short as (
  select s1, cid from (select s1, cid, row_number() over (partition by s1 order by {_SCORE} desc, cid) as rn
    from cand join rec a on a.entity_id = s1 join rec b on b.entity_id = cid) where rn <= 100),
sorted as (
  select entity_id, array_to_string(list_sort({_TOKENS.format("name_core")}), ' ') as s from rec),
texts as (select distinct a.s as x, b.s as y from short join sorted a on a.entity_id = s1 join sorted b on b.entity_id = cid),
{_FOLD},
sim as (
  select x, y, case when x = '' and y = '' then 100.0 else 200.0 * n / (length(x) + length(y)) end as ratio from lcs),
paired as (
  select s1, cid, ratio, a.pin as p1, b.pin as p2,
    case when a.house_no <> '' and a.house_no = b.house_no then case when a.pin <> '' and a.pin = b.pin then 25 else 15 end when a.pin <> '' and a.pin = b.pin then 10 else 0 end
    + case when list_has_any(a.addr_tokens, b.addr_tokens) then 10 else 0 end as bonus
  from short join rec a on a.entity_id = s1 join rec b on b.entity_id = cid join sorted x on x.entity_id = s1 join sorted y on y.entity_id = cid join sim on sim.x = x.s and sim.y = y.s),
top as (
  select * from (select *, least(100.0, ratio + bonus) as score, row_number() over (partition by s1 order by least(100.0, ratio + bonus) desc, cid) as rank from paired) where rank <= 20),
rules as (select s1, cid, least(100.0, ratio + case when p1 <> '' and p1 = p2 then {E.PIN_BONUS} else 0 end) as score from top)"""


def _light() -> str:
    return f"""{_scored()},
light as (select s1, cid, floor(score * 10000) / 1000000 as score from rules)"""


_F = "case when p <= 0 or r <= 0 then 0.0 else 1.25 * p * r / (0.25 * p + r) end"
_ENTITY = "case when n = 0 and m = 0 then 1.0 when n = 0 or m = 0 then 0.0 when k = 0 then 0.0 else 1.25 * (k / n) * (k / m) / (0.25 * k / n + k / m) end"
_SUMMARY = f"""round(avg({_ENTITY}), 6) as macro_f05, round(coalesce(avg(case when n > 0 then k / n end), 0), 6) as mean_precision,
  round(coalesce(avg(case when m > 0 then k / m end), 0), 6) as mean_recall, sum(k)::bigint as pair_tp, sum(n - k)::bigint as pair_fp, sum(m - k)::bigint as pair_fn, count(*) as entities"""


def _swept(scores: str, points) -> str:
    values = ", ".join(f"({x}::double)" for x in points)
    return f"""grid as (select * from (values {values}) g(threshold)),
each as (
  select threshold, u.s1, (select count(*) from truth where truth.s1 = u.s1) as m, count(s.cid) filter (where s.score >= threshold) as n,
    count(t.cid) filter (where s.score >= threshold) as k
  from grid cross join uni u left join {scores} s on s.s1 = u.s1 left join truth t on t.s1 = s.s1 and t.cid = s.cid group by threshold, u.s1),
curve as (select threshold, {_SUMMARY} from each group by threshold)"""


_BEST = """, top_curve as (select max(macro_f05) as best from raw_curve)
select min(threshold) filter (where macro_f05 = best) as threshold, round(max(best), 6) as macro_f05, max(threshold) filter (where macro_f05 >= best - 0.001) as threshold_conservative
from raw_curve, top_curve"""
_RAW_CURVE = f", raw_curve as (select threshold, avg({_ENTITY}) as macro_f05 from each group by threshold)"


def _sims(**columns: str) -> str:
    chosen = ", ".join(f"round({sql}, 6) as {name}" for name, sql in columns.items())
    return f"with {_blocks().strip()} select s1, cid, {chosen} from (select distinct s1, cid from hit where kind = 'name_key') join rec a on a.entity_id = s1 join rec b on b.entity_id = cid"


def _lev(c: str) -> str:
    return f"1 - levenshtein(a.{c}, b.{c}) / greatest(length(a.{c}), length(b.{c}), 1)"


def _jac(x: str, y: str) -> str:
    return f"len(list_intersect({x}, {y})) / len(list_distinct(list_concat({x}, {y})))"


def _grams(c: str) -> str:
    def grams(s: str) -> str:
        return f"list_distinct(list_transform(range(1, length({s}.{c}) - 1), lambda i: substr({s}.{c}, i::int, 3)))"

    return f"case when a.{c} = '' or b.{c} = '' then 0.0 when a.{c} = b.{c} then 1.0 when length(a.{c}) < 3 or length(b.{c}) < 3 then 0.0 else {_jac(grams('a'), grams('b'))} end"


def _words(c: str) -> str:
    x, y = (f"list_distinct({_TOKENS.format(f'{s}.{c}')})" for s in "ab")
    return f"case when a.{c} = '' or b.{c} = '' then 0.0 when a.{c} = b.{c} then 1.0 else {_jac(x, y)} end"


def _jaro(c: str) -> str:
    return f"case when a.{c} = '' and b.{c} = '' then 1.0 else jaro_winkler_similarity(a.{c}, b.{c}) end"


def _token_sort() -> str:
    text = f"array_to_string(list_sort({_TOKENS.format('{}.name_core')}), ' ')"
    return f"""with recursive {_blocks().strip()},
pairs as (select s1, cid, {text.format("a")} as x, {text.format("b")} as y from (select distinct s1, cid from hit where kind = 'name_key') join rec a on a.entity_id = s1 join rec b on b.entity_id = cid),
texts as (select distinct x, y from pairs), {_FOLD}
select s1, cid, round(case when x = '' and y = '' then 100.0 else 200.0 * n / (length(x) + length(y)) end, 6) as name_core_sim from pairs join lcs using (x, y)"""


def _token_set() -> str:
    words = f"list_distinct({_TOKENS.format('{}.name_core')})"
    return f"""with recursive {_blocks().strip()},
sets as (select s1, cid, {words.format("a")} as p, {words.format("b")} as q from (select distinct s1, cid from hit where kind = 'name_key') join rec a on a.entity_id = s1 join rec b on b.entity_id = cid),
pairs as (
  select s1, cid, len(p) as np, len(q) as nq, len(list_intersect(p, q)) as n_both, length(array_to_string(list_intersect(p, q), ' ')) as shared,
    array_to_string(list_sort(list_filter(p, lambda t: not list_contains(q, t))), ' ') as x, array_to_string(list_sort(list_filter(q, lambda t: not list_contains(p, t))), ' ') as y
  from sets),
texts as (select distinct x, y from pairs), {_FOLD},
sized as (select *, length(x) as lx, length(y) as ly, case when n_both > 0 then 1 else 0 end as gap from pairs join lcs using (x, y))
select s1, cid, round(case when np = 0 or nq = 0 then 0.0 when n_both > 0 and (np = n_both or nq = n_both) then 100.0 else greatest(
  100.0 - 100.0 * (lx + ly - 2 * n) / (2 * (shared + gap) + lx + ly),
  case when n_both > 0 then 100.0 - 100.0 * (1 + lx) / (2 * shared + 1 + lx) else 0.0 end, case when n_both > 0 then 100.0 - 100.0 * (1 + ly) / (2 * shared + 1 + ly) else 0.0 end) end, 6) as name_core_sim
from sized"""


def _structured() -> str:
    out = {}
    for kind, text, n, tokens in (("name", "clean_name", "name_len", "name_tokens"), ("addr", "clean_addr", "addr_len", "addr_tokens_n")):
        out |= {
            f"{kind}_exact": f"(a.{text} <> '' and a.{text} = b.{text})::int", f"{kind}_levenshtein": _lev(text), f"{kind}_char_ngram_jaccard": _grams(text),
            f"{kind}_token_jaccard": _words(text), f"{kind}_len_diff": f"abs(a.{n} - b.{n})", f"{kind}_len_ratio": f"least(a.{n}, b.{n}) / greatest(a.{n}, b.{n}, 1)",
            f"{kind}_tokens_diff": f"abs(a.{tokens} - b.{tokens})", f"missing_{kind}_s1": f"(a.{text} = '')::int", f"missing_{kind}_cand": f"(b.{text} = '')::int",
            f"s1_{kind}_tokens": f"a.{tokens}", f"cand_{kind}_tokens": f"b.{tokens}",
        }
    for kind, column in (("pin", "pin"), ("house", "house_feat"), ("city", "city")):
        both = f"a.{column} <> '' and b.{column} <> ''"
        out |= {f"has_{kind}_both": f"({both})::int", f"{kind}_match": f"({both} and a.{column} = b.{column})::int", f"{kind}_mismatch": f"({both} and a.{column} <> b.{column})::int"}
    out |= {
        "name_core_exact": "(a.name_core <> '' and a.name_core = b.name_core)::int", "name_core_levenshtein": _lev("name_core"),
        "country_match": "(a.country_norm <> '' and a.country_norm = b.country_norm)::int", "city_token_overlap": _words("city"),
        "pin_prefix_match": "(length(a.pin) >= 3 and length(b.pin) >= 3 and substr(a.pin, 1, 3) = substr(b.pin, 1, 3))::int",
    }
    return _sims(**{n: f"({out[n]})::double" for n in STRUCTURED})


_BAD = f"""with {BASE.strip()},
numbered as (select entity_id, cast(substr(entity_id, 4, 7) as bigint) as n from rec where entity_id like 'S1-%'),
said as (
  select entity_id, n, concat('S2-', lpad(cast(n + 1 as varchar), 7, '0')) as mate from numbered),
lines as (
  select n + 2 as line_no, case when n % 30 = 18 then entity_id when n % 30 = 21 then concat('S1-8', substr(entity_id, 5, 6), chr(9)) else concat(entity_id, chr(9),
    case n % 30 when 0 then mate || ',' || mate when 3 then entity_id when 6 then 'X-1' when 9 then mate || ',' when 12 then 'S3-9999999' when 15 then '' else mate end) end as line, n from said),
doubled as (select line_no, line from lines union all select n + 10000000, line from lines where n % 30 = 24),
cut as (select line_no, split_part(line, chr(9), 1) as s1, substr(line, strpos(line, chr(9)) + 1) as rest from doubled where contains(line, chr(9))),
parsed as (select line_no, s1, case when trim(rest) = '' then [] else string_split(rest, ',') end as ids from cut),
ids as (select s1, unnest(ids) as id from parsed)"""
_TELL = "select '{}' as rule, '{}' as level, count(*) as n, array_to_string(list_sort(list(x))[1:5], ';') as examples from (select distinct x from ({}))"


def _findings() -> str:
    rules = {
        "malformed_row": "select printf('line %010d', line_no) as x from doubled where not contains(line, chr(9)) and trim(line) <> ''",
        "duplicate_s1": "select s1 as x from parsed group by s1 having count(*) > 1",
        "repeated_id": "select s1 as x from parsed where len(ids) <> len(list_distinct(ids))",
        "self_match": "select id as x from ids where starts_with(id, 'S1-')",
        "wrong_prefix": "select id as x from ids where not (starts_with(id, 'S1-') or starts_with(id, 'S2-') or starts_with(id, 'S3-'))",
        "missing_s1": "select entity_id as x from numbered where entity_id not in (select s1 from parsed)",
        "extra_s1": "select s1 as x from parsed where s1 not in (select entity_id from numbered)",
        "unknown_id": "select id as x from ids where (starts_with(id, 'S2-') or starts_with(id, 'S3-')) and id not in (select entity_id from rec where entity_id not like 'S1-%')",
    }
    told = " union all ".join(_TELL.format(rule, "error", sql) for rule, sql in rules.items())
    return f"{_BAD} select * from ({told}) where n > 0"


def oracle_sql() -> dict[str, str]:
    base, blocks, light, scored = f"with {BASE.strip()}", f"with {_blocks().strip()}", _light(), _scored()
    in_kind = "{} select distinct s1, cid from hit where kind = '{}'"
    predicted = f"{light}, each as (select u.s1, (select count(*) from truth where truth.s1 = u.s1) as m, count(s.cid) as n, count(t.cid) as k from uni u left join (select * from light where score >= 0.5) s on s.s1 = u.s1 left join truth t on t.s1 = s.s1 and t.cid = s.cid group by u.s1)"
    matched = "select u.s1 as source1_entity_id, coalesce(string_agg(distinct s.cid, ',' order by s.cid), '') as matched_entity_ids from uni u left join (select * from {} where score >= {}) s on s.s1 = u.s1 group by u.s1"
    labelled = f"{blocks}, lab as (select cand.s1, cand.cid, (truth.cid is not null)::int as label from cand left join truth on truth.s1 = cand.s1 and truth.cid = cand.cid)"
    with_score = f"{blocks}, scored as (select s1, cid, {_SCORE} as shortlist_score from cand join rec a on a.entity_id = s1 join rec b on b.entity_id = cid), placed as (select *, row_number() over (partition by s1 order by shortlist_score desc, cid) as rn from scored)"
    lists = f"{blocks} select s1, string_agg(distinct cid, ',' order by cid) as ids from hit where kind = 'name_key' group by s1"
    report_points = ", ".join(f"({x}::double)" for x in E.REPORT_GRID)
    out = {
        "clean_name": f"{base} select entity_id, clean_name from rec",
        "clean_address": f"{base} select entity_id, clean_addr from rec",
        "name_core": f"{base} select entity_id, name_core from rec",
        "pin_house_city": f"{base} select entity_id, pin, house_no, house_feat, city, country_norm, name_len, addr_len, name_tokens, addr_tokens_n, trim(concat(clean_name, ' ', clean_addr)) as combined from rec",
        "name_key": f"{base} select entity_id, name_key from rec",
        "sig_tokens": f"{base} select entity_id, array_to_string(sig_tokens, '|') as tokens from rec",
        "addr_tokens": f"{base} select entity_id, array_to_string(addr_tokens, '|') as tokens from rec",
        "union_sources": f"{base} select * from raw where entity_id like 'S2-%' union all select * from raw where entity_id like 'S3-%'",
        "semi_needed": f"{base} select * from raw where entity_id in (select cid from truth)",
        "anti_resume": f"{base} select entity_id, clean_name from rec where entity_id like 'S1-%' and entity_id not in (select s1 from truth)",
        "collect_ids": lists,
        "explode_ids": f"{blocks}, l as (select s1, cid, row_number() over (partition by s1 order by cid) as rank from (select distinct s1, cid from hit where kind = 'name_key')) select s1, cid, rank from l",
        "block_name_key_low_cap": in_kind.format(f"with {_blocks(LOW_CAPS).strip()}", "name_key"),
        "candidates_union": f"{blocks} select s1, cid from cand",
        "candidates_with_empty": f"{blocks} select uni.s1, count(cand.cid) as n from uni left join cand on cand.s1 = uni.s1 group by uni.s1",
        "shortlist": f"{with_score} select s1, cid, shortlist_score from placed where rn <= {B.SHORTLIST}",
        "rerank_topk": f"{scored} select s1, cid, round(score, 6) as score, rank from top",
        "candidate_lists": f"{scored} select uni.s1 as source1_entity_id, coalesce(string_agg(top.cid, ',' order by top.rank), '') as candidate_entity_ids from uni left join top on top.s1 = uni.s1 group by uni.s1",
        "blocking_recall": f"""{blocks}, n as (select uni.s1, count(cand.cid) as n from uni left join cand on cand.s1 = uni.s1 group by uni.s1)
select (select count(*) from n) as sampled_s1, (select round(avg(n), 6) from n) as avg_candidates, (select max(n) from n) as max_candidates, count(distinct truth.s1) as s1_with_truth,
  count(*) as true_total, count(cand.cid) as captured, round(coalesce(count(cand.cid) / nullif(count(*), 0), 1.0), 6) as recall from truth left join cand on cand.s1 = truth.s1 and cand.cid = truth.cid""",
        "blocking_volume": f"""{scored}, n as (select uni.s1, (select count(*) from cand where cand.s1 = uni.s1) as r, (select count(*) from top where top.s1 = uni.s1) as f from uni)
select count(*) as s1_total, sum(r)::bigint as raw_candidates, sum(f)::bigint as final_candidates, round(avg(r), 6) as avg_raw, round(avg(f), 6) as avg_final, max(f) as max_final from n""",
        "sim_levenshtein": _sims(clean_name_sim=_lev("clean_name"), clean_addr_sim=_lev("clean_addr")),
        "sim_ngram_jaccard": _sims(clean_name_sim=_grams("clean_name"), clean_addr_sim=_grams("clean_addr")),
        "sim_token_jaccard": _sims(clean_name_sim=_words("clean_name"), clean_addr_sim=_words("clean_addr")),
        "sim_jaro_winkler": _sims(clean_name_sim=_jaro("clean_name"), clean_addr_sim=_jaro("clean_addr")),
        "sim_token_sort": _token_sort(),
        "sim_token_set": _token_set(),
        "features_finite": f"{scored} select count(*) as rows, 0::bigint as not_finite from top",
        "pair_features_structured": _structured(),
        "labels": f"{labelled} select s1, cid, label from lab",
        "split_hash": f"{blocks} select s1, concat('0x', substr(md5(concat('42|', s1)), 1, 8))::bigint % 1000 < 200 as is_val from uni",
        "class_balance": f"{labelled}, e as (select s1, count(*) as n, sum(label) as p from lab group by s1) select sum(n)::bigint as pairs, count(*) as entities, sum(p)::bigint as positives, round(sum(p) / sum(n), 6) as positive_rate, count(*) filter (where p = 0) as singletons from e",
        "entity_scores": f"{predicted} select s1, n as pred_n, m as true_n, k as tp, round({_ENTITY}, 6) as score from each",
        "macro_f05": f"{predicted} select {_SUMMARY} from each",
        "evaluation_report": f"""{light}, grid as (select * from (values {report_points}) g(threshold)),
marked as (select l.*, truth.cid is not null as y from light l left join truth on truth.s1 = l.s1 and truth.cid = l.cid),
c as (select threshold, count(*) filter (where y and score >= threshold) as tp, count(*) filter (where score >= threshold) as pos, count(*) filter (where y) as total from grid cross join marked group by threshold),
pr as (select *, coalesce(tp / nullif(pos, 0), 0.0) as p, coalesce(tp / nullif(total, 0), 0.0) as r from c), {_swept("light", E.REPORT_GRID).split("," + chr(10), 1)[1]}
select pr.threshold, round(p, 6) as pair_precision, round(r, 6) as pair_recall, round({_F}, 6) as pair_f05, tp, pos - tp as fp, total - tp as fn, pos as pred_pos, curve.macro_f05 from pr join curve on curve.threshold = pr.threshold""",
        "rule_scores": f"{scored} select s1, cid, round(score, 6) as score from rules",
        "rule_sweep": f"{scored}, {_swept('rules', E.RULE_GRID)} select * from curve",
        "rule_best": f"{scored}, {_swept('rules', E.RULE_GRID)}{_RAW_CURVE}{_BEST}",
        "rule_matches": f"{scored} {matched.format('rules', MATCH_AT)}",
        "threshold_sweep": f"{light}, {_swept('light', E.PROBABILITY_GRID)} select * from curve",
        "threshold_conservative": f"{light}, {_swept('light', E.PROBABILITY_GRID)}{_RAW_CURVE}{_BEST}",
        "final_matches": f"{light} {matched.format('light', 0.5)}",
        "decision_counts": f"""{light}, passed as (select uni.s1, count(light.cid) as n from uni left join light on light.s1 = uni.s1 and score >= 0.5 group by uni.s1)
select count(*) as entities, count(*) filter (where n > 0) as matched_entities, sum(n)::bigint as matches, (select count(*) from light) as pairs, round(sum(n) / (select count(*) from light), 6) as pass_rate from passed""",
        "subset_violations": f"""{light} select count(distinct l.s1) as entities, count(*) as pairs from light l where score >= 0.5 and not exists (select 1 from top where top.s1 = l.s1 and top.cid = l.cid and rank <= 5)""",
        "score_verification": f"{light} select (select count(*) from top) as pairs, count(*) as scored, count(*) filter (where not score between 0 and 1) as out_of_range, count(*) - count(distinct s1 || cid) as repeated, round(min(score), 6) as min_score, round(max(score), 6) as max_score, round(avg(score), 6) as mean_score from light",
        "tsv_records": f"{base} select entity_id, nullif(business_name, '') as business_name, nullif(business_address, '') as business_address, nullif(country, '') as country from raw",
        "tsv_scores": f"{light} select s1 as source1_entity_id, cid as candidate_entity_id, score as match_probability from light",
        "tsv_candidates": f"{scored} select s1, cid, rank from top",
        "validator_findings": _findings(),
        "validator_subset": f"""{_BAD}, last as (select s1, ids, row_number() over (partition by s1 order by line_no desc) as rn from parsed),
extra as (select distinct s1 as x from (select s1, unnest(ids) as id from last where rn = 1) where id <> 'S3-9999999' or s1 not in (select entity_id from numbered))
select 'match_not_candidate' as rule, 'warning' as level, count(*) as n, array_to_string(list_sort(list(x))[1:5], ';') as examples from extra""",
        "validator_counts": f"{_BAD} select count(*) as n_rows, count(*) filter (where len(ids) = 0) as empty_rows from parsed",
    }
    return out | {f"block_{kind}": in_kind.format(blocks, kind) for kind in B.CAPS}
