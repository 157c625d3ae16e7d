"""The same results in plain SQL, by direct comparison of every pair where need be."""

from __future__ import annotations

from lexvane.config import INFO_ENTITY_TYPES, INFO_KEYWORDS
from lexvane.functions.aliases import REFUSALS

# Characters that count as blank, and the same as a class of a regular expression.
BLANKS = "".join(
    map(
        chr,
        [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)
BLANK_CLASS = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def clean(x: str) -> str:
    return rf"trim(regexp_replace(lower(coalesce({x}, '')), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))"


def normalize(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[.\\-_{BLANK_CLASS}]+', ' ', 'g'))"


def strip(x: str) -> str:
    return f"trim({x}, '{BLANKS}')"


def any_of(text: str, words) -> str:
    return "(" + " or ".join(f"contains({text}, '{w}')" for w in words) + ")"


DOCS = f"docs as (select doc_id, text, {clean('text')} as c from documents)"


def runs(words: int, name: str = "terms") -> str:
    return f"""{name} as (select distinct array_to_string(w[i:i + {words - 1}], ' ') as term from (
      select w, unnest(range(1, len(w) - {words - 2})) as i
      from (select string_split({clean('text')}, ' ') as w from benchmark) where len(w) >= {words}))"""


LONG_WORDS = f"""terms as (select distinct term from (
  select unnest(string_split({clean('text')}, ' ')) as term from benchmark) where length(term) >= 4)"""


def flagged(terms: str, hit: str = "contains(c, term)") -> str:
    return f"""with {DOCS}, {terms},
    hits as (select distinct doc_id from docs, terms where {hit})
    select doc_id, cast(doc_id in (select doc_id from hits) as integer) as malware_flag from docs"""


GAZETTEER = """names as (select distinct name from (
  select n_name as name, 'GPE' as type from nation
  union all select r_name, 'GPE' from region
  union all select string_split(text, ' ')[1], 'PRODUCT' from benchmark
  union all select role, 'ROLE' from conversations) where type in ({}) and name <> '')""".format(
    ", ".join(f"'{t}'" for t in INFO_ENTITY_TYPES)
)

# Spans of the report-shaped documents: (doc_id, idx, label, s, e, text).
SPANS = """spans as (
  select doc_id, text, 1 as idx, case when strpos(text, ' ') > 6 then 'Malware' else 'TOOL' end as label, 0 as s, strpos(text, ' ') - 1 as e from documents
  union all
  select doc_id, text, 2, case lang when 'es' then 'MALWARE' when 'fr' then 'malware' else 'TOOL' end,
    strpos(text, ' '), strpos(text, ' ') + 8 from documents
  union all
  select doc_id, text, 3, case when source = 'src7' then 'malware' end,
    length(text) - 6, length(text) - 6 + strpos(text, ' ') from documents)"""

VALID = "(s >= 0 and s < e and e <= length(text))"

NAMED = f"""{SPANS}, named as (select doc_id, idx, {strip('substring(text, cast(s as integer) + 1, cast(e - s as integer))')} as name
  from spans where lower(label) = 'malware' and {VALID})"""


def built(min_length: int, name: str = "terms") -> str:
    return f"""{NAMED}, {name} as (select distinct term from (
      select {normalize('name')} as term from named where name <> '') where length(term) >= {min_length})"""


REFUSED = any_of("lower({0})", [phrase.replace("'", "''") for phrase in REFUSALS])


def alias_rows(source: str, key: str, text: str) -> str:
    """Alias terms of every answer as rows (key, term)."""
    body = strip(text)
    kept = f"not ({body} = '' or ({REFUSED.format(body)} and not contains({body}, ',')))"
    return f"""select * from (
      select {key}, {normalize('item')} as term from (
        select {key}, unnest(string_split({body}, ',')) as item from {source} where {kept}))
      where length(term) >= 4 and not starts_with(term, 'i don''t')"""


ANSWERS = "answers as (select string_split(text, ' ')[1] as name, text as content from conversations)"
ALIASES = f"""{NAMED}, {ANSWERS},
  names as (select distinct name from named where name <> ''),
  asked as (select * from names where length(name) >= 4),
  base as (select distinct term from (select {normalize('name')} as term from names) where length(term) >= 4),
  found as (select asked.name, content from asked left join answers using (name)),
  aliases as (select distinct term from ({alias_rows('found', 'name', 'content')}))"""

SIMPLE = """simple as (select distinct l_orderkey, least(l_partkey, l_suppkey) as a, greatest(l_partkey, l_suppkey) as b from lineitem),
  ends as (select l_orderkey, a as node from simple union all select l_orderkey, b from simple),
  degrees as (select l_orderkey, node, cast(count(*) as integer) as degree from ends group by all),
  labelled as (select distinct l_orderkey, l_partkey as node from lineitem join part on l_partkey = p_partkey where p_brand = 'Brand#13'),
  top as (select l_orderkey, max(degree) as d from degrees join labelled using (l_orderkey, node) group by all),
  totals as (select l_orderkey, cast(count(*) as integer) as n from lineitem group by all)"""

GRAPH = """select o_orderkey as l_orderkey, coalesce(d, 0) as graph_max_malware_degree, coalesce(n, 0) as graph_total_edges
  from orders left join totals on o_orderkey = totals.l_orderkey left join top on o_orderkey = top.l_orderkey"""

LINES = """numbered as (select l_orderkey, l_partkey as id,
    cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as integer) as idx from lineitem),
  labels_of as (select l_orderkey, idx, id, case when p_brand = 'Brand#13' then 'Malware' else p_type end as label
    from numbered join part on id = p_partkey)"""

TARGETS = """targets as (select l_orderkey, max(cast(coalesce(lower(label) = 'malware', false) as integer)) as true_label
  from labels_of group by all)"""

MATRIX = f"""flags as ({flagged(runs(4)).replace('with ', 'with ', 1)}),
  m as (select
    count(*) filter (toxic = 0 and malware_flag = 0) as tn, count(*) filter (toxic = 0 and malware_flag = 1) as fp,
    count(*) filter (toxic = 1 and malware_flag = 0) as fn, count(*) filter (toxic = 1 and malware_flag = 1) as tp
    from flags join labels using (doc_id))"""


def ratio(a: str, b: str) -> str:
    return f"(case when {b} = 0 then 0.0 else cast({a} as double) / ({b}) end)"


REPORT = f"""with {MATRIX}, r as (select *,
    tn + fp as s0, fn + tp as s1, tn + fp + fn + tp as n, {ratio('tn + tp', 'tn + fp + fn + tp')} as acc,
    {ratio('tn', 'tn + fn')} as p0, {ratio('tn', 'tn + fp')} as r0, {ratio('2 * tn', '2 * tn + fn + fp')} as f0,
    {ratio('tp', 'tp + fp')} as p1, {ratio('tp', 'tp + fn')} as r1, {ratio('2 * tp', '2 * tp + fp + fn')} as f1 from m),
  lines as (
    select 'Not Malware (0)' as class, p0 as p, r0 as r, f0 as f, s0 as support from r
    union all select 'Malware (1)', p1, r1, f1, s1 from r
    union all select 'accuracy', acc, acc, acc, n from r
    union all select 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n from r
    union all select 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n from r)
  select class, round(p, 9) as precision, round(r, 9) as recall, round(f, 9) as f1, support from lines"""

# Test rows per class: the total rounded up, shared out by largest remainder.
SIZES = """c as (select toxic, count(*) as n from labels group by all),
  t as (select sum(n) as rows, ceil(sum(n) * 0.2) as wanted from c),
  x as (select toxic, n, wanted * n / rows as exact, wanted from c, t),
  s as (select toxic, n, floor(exact) as low, row_number() over (order by exact - floor(exact) desc, toxic) as place,
    wanted - sum(floor(exact)) over () as spare from x),
  sizes as (select toxic, n, cast(low + (case when place <= spare then 1 else 0 end) as bigint) as test from s)"""

HASH = "(doc_id * 2654435761) % 4294967296"


def summary(table: str, column: str) -> str:
    return f"""select '{column}' as "column", count({column}) as count, round(avg({column}), 6) as mean,
      round(stddev_samp({column}), 6) as std, cast(min({column}) as double) as min,
      round(quantile_cont({column}, 0.25), 6) as p25, round(quantile_cont({column}, 0.5), 6) as p50,
      round(quantile_cont({column}, 0.75), 6) as p75, cast(max({column}) as double) as max from {table}"""


def scaled(column: str) -> str:
    return f"round(({column} - avg({column}) over ()) / stddev_pop({column}) over (), 6) as {column}"


def features(terms: str) -> str:
    """All features of the report-shaped documents, for a dictionary ``terms`` (which brings ``spans``)."""
    return f"""with {DOCS}, {GAZETTEER}, {terms}, {SIMPLE},
  flags as (select distinct doc_id from docs, terms where contains(c, term)),
  entity as (select distinct doc_id from docs, names where contains(text, name)),
  firsts as (select l_orderkey, arg_min(l_partkey, (l_linenumber, l_partkey, l_suppkey)) as id from lineitem group by all),
  nodes as (
    select doc_id, coalesce(id, doc_id) as node from spans left join firsts on doc_id = l_orderkey
      where idx = 1 and lower(label) = 'malware'
    union select doc_id, s from spans where idx = 2 and lower(label) = 'malware'
    union select doc_id, length(text) from spans where idx = 3 and lower(label) = 'malware'),
  best as (select doc_id, max(degree) as d from nodes join degrees on doc_id = l_orderkey and nodes.node = degrees.node group by all)
  select docs.doc_id, cast(docs.doc_id in (select doc_id from flags) as integer) as malware_flag,
    cast({any_of('c', INFO_KEYWORDS)} as integer) as has_info_keywords,
    cast(docs.doc_id in (select doc_id from entity) as integer) as has_info_entities,
    coalesce(d, 0) as graph_max_malware_degree, coalesce(n, 0) as graph_total_edges, cast(docs.doc_id in (select doc_id from spans where lower(label) = 'malware') as integer) as true_label
  from docs left join best using (doc_id) left join totals on docs.doc_id = totals.l_orderkey"""


FEATURES = features(built(4))


def splitted(table: str, label: str = "true_label") -> str:
    """CTEs that end in ``splitted``: the table with ``is_test``, by class and hash order."""
    return f"""c_ as (select {label} as y, count(*) as n from {table} group by all),
  t_ as (select sum(n) as rows, ceil(sum(n) * 0.2) as wanted from c_),
  x_ as (select y, n, wanted * n / rows as exact, wanted from c_, t_),
  s_ as (select y, n, floor(exact) as low, row_number() over (order by exact - floor(exact) desc, y) as place,
    wanted - sum(floor(exact)) over () as spare from x_),
  z_ as (select y, cast(low + (case when place <= spare then 1 else 0 end) as bigint) as test from s_),
  p_ as (select *, row_number() over (partition by {label} order by {HASH}, doc_id) as place_ from {table}),
  splitted as (select p_.*, place_ <= test as is_test from p_ join z_ on p_.{label} = z_.y)"""


def newton(name: str, rows: str, columns: list[str], label: str, steps: int = 12) -> str:
    """CTEs that end in ``{name}`` with ``b0..bk``: a penalized, class-weighted logistic fit.

    Every step is one aggregate over the merged rows and a Cholesky solution
    written out; features are scaled, the last coefficient is the intercept.
    """
    k = len(columns)
    n, cells = k + 1, [(i, j) for i in range(k + 1) for j in range(i + 1)]
    merged = ", ".join(f"cast({c} as double) as f{i}" for i, c in enumerate(columns))
    out = [
        f"{name}_m as (select {label} as y, {merged}, count(*) as n from {rows} group by all)",
        f"{name}_c as (select y, sum(n) as ny, sum(sum(n)) over () as total from {name}_m group by y)",
        f"{name}_a as (select " + ", ".join(f"sum(f{i} * n) / sum(n) as m{i}" for i in range(k)) + f" from {name}_m)",
        f"{name}_d as (select " + ", ".join(f"sqrt(sum((f{i} - m{i}) * (f{i} - m{i}) * n) / sum(n)) as d{i}" for i in range(k)) + f" from {name}_m, {name}_a)",
        f"{name}_s as (select *, " + ", ".join(f"case when d{i} = 0 then 1.0 else d{i} end as e{i}" for i in range(k)) + f" from {name}_a, {name}_d)",
        f"{name}_p as (select cast(m.y as double) as y, n * total / (2.0 * ny) as w, "
        + ", ".join(f"(f{i} - m{i}) / e{i} as x{i}" for i in range(k))
        + f", 1.0 as x{k} from {name}_m m join {name}_c c using (y), {name}_s)",
        f"{name}_0 as (select " + ", ".join(f"cast(0 as double) as b{i}" for i in range(n)) + ")",
    ]
    for t in range(steps):
        z = " + ".join(f"b{i} * x{i}" for i in range(n))
        sums = [f"sum(w * (p - y) * x{i}) + any_value(b{i}) as g{i}" for i in range(n)]
        sums += [f"sum(w * p * (1 - p) * x{i} * x{j}){' + 1' if i == j else ''} as h{i}_{j}" for i, j in cells]
        sums += [f"any_value(b{i}) as b{i}" for i in range(n)]
        solve = []
        for i, j in sorted(cells, key=lambda c: (c[1], c[0])):
            rest = "".join(f" - l{i}_{q} * l{j}_{q}" for q in range(j))
            solve.append(f"sqrt(h{i}_{j}{rest}) as l{i}_{j}" if i == j else f"(h{i}_{j}{rest}) / l{j}_{j} as l{i}_{j}")
        for i in range(n):
            solve.append(f"(g{i}" + "".join(f" - l{i}_{q} * v{q}" for q in range(i)) + f") / l{i}_{i} as v{i}")
        for i in reversed(range(n)):
            solve.append(f"(v{i}" + "".join(f" - l{q}_{i} * u{q}" for q in range(i + 1, n)) + f") / l{i}_{i} as u{i}")
        out.append(f"{name}_g{t} as (select {', '.join(sums)} from (select *, 1 / (1 + exp(-({z}))) as p from {name}_p, {name}_{t}))")
        out.append(f"{name}_l{t} as (select *, {', '.join(solve)} from {name}_g{t})")
        last = name if t == steps - 1 else f"{name}_{t + 1}"
        out.append(f"{last} as (select " + ", ".join(f"b{i} - u{i} as b{i}" for i in range(n)) + f" from {name}_l{t})")
    return ",\n  ".join(out)


def scored(name: str, columns: list[str]) -> str:
    """The score of a row by a fit, from its scaled features."""
    parts = [f"{name}.b{i} * (cast({c} as double) - {name}_s.m{i}) / {name}_s.e{i}" for i, c in enumerate(columns)]
    return " + ".join([*parts, f"{name}.b{len(columns)}"])


TEXT_FEATURES = ["malware_flag", "has_info_keywords", "has_info_entities"]
GRAPH_FEATURES = [*TEXT_FEATURES, "graph_max_malware_degree", "graph_total_edges"]


def compared(table: str) -> str:
    """CTEs that end in ``m``: the matrices of the three detectors on the test rows of ``table``."""
    return f"""{splitted(table)},
  train as (select * from splitted where not is_test),
  {newton('tf', 'train', TEXT_FEATURES, 'true_label')},
  {newton('gf', 'train', GRAPH_FEATURES, 'true_label')},
  judged as (
    select true_label as y, malware_flag as p0, cast({scored('tf', TEXT_FEATURES)} > 0 as integer) as p1,
      cast({scored('gf', GRAPH_FEATURES)} > 0 as integer) as p2
    from splitted, tf, tf_s, gf, gf_s where is_test),
  each as (select 'dictionary_only' as model, y, p0 as p from judged union all select 'text_flags', y, p1 from judged
    union all select 'graph', y, p2 from judged),
  m as (select model, count(*) filter (y = 0 and p = 0) as tn, count(*) filter (y = 0 and p = 1) as fp,
    count(*) filter (y = 1 and p = 0) as fn, count(*) filter (y = 1 and p = 1) as tp from each group by model)"""


def reported(ctes: str) -> str:
    """The report lines of every model, after CTEs that end in ``m``."""
    return f"""with {ctes}, r as (select *,
    tn + fp as s0, fn + tp as s1, tn + fp + fn + tp as n, {ratio('tn + tp', 'tn + fp + fn + tp')} as acc,
    {ratio('tn', 'tn + fn')} as p0, {ratio('tn', 'tn + fp')} as r0, {ratio('2 * tn', '2 * tn + fn + fp')} as f0,
    {ratio('tp', 'tp + fp')} as p1, {ratio('tp', 'tp + fn')} as r1, {ratio('2 * tp', '2 * tp + fp + fn')} as f1 from m),
  lines as (
    select model, 'Not Malware (0)' as class, p0 as p, r0 as r, f0 as f, s0 as support from r
    union all select model, 'Malware (1)', p1, r1, f1, s1 from r
    union all select model, 'accuracy', acc, acc, acc, n from r
    union all select model, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n from r
    union all select model, 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n from r)
  select model, class, round(p, 9) as precision, round(r, 9) as recall, round(f, 9) as f1, support from lines"""


# The dictionary of the training rows, whose labels come from the spans themselves.
TRAINED = f"""{SPANS},
  labelled_docs as (select doc_id, max(cast(coalesce(lower(label) = 'malware', false) as integer)) as true_label from spans group by doc_id),
  {splitted('labelled_docs')},
  named as (select doc_id, {strip('substring(text, cast(s as integer) + 1, cast(e - s as integer))')} as name
    from spans where lower(label) = 'malware' and {VALID} and doc_id in (select doc_id from splitted where not is_test)),
  terms as (select distinct term from (select {normalize('name')} as term from named where name <> '') where length(term) >= 4)"""
TERM_LIST = f"with {TRAINED} select term from terms"
RUN = f"feats as ({features(TRAINED)}), {compared('feats')}"


def oracle_sql() -> dict[str, str]:
    flag = flagged(runs(4))
    return {
        "clean_text": f"select doc_id, {clean('text')} as clean_text from documents",
        "normalize_names": f"select p_partkey, {normalize(chr(40) + 'p_brand || chr(45) || p_name || chr(45) || ' + repr('V_') + ' || p_size || ' + repr('.0 ') + chr(41))} as name from part",
        "dictionary_match": flag,
        "dictionary_match_scan": flag,
        "dictionary_match_indexed": flag,
        "dictionary_match_shuffled": flag,
        "dictionary_match_whole_word": flagged(runs(4), "contains(' ' || c || ' ', ' ' || term || ' ')"),
        "dictionary_match_words": flagged(LONG_WORDS),
        "dictionary_minimize": f"""with {runs(1, 'a')}, {runs(2, 'b')}, terms as (select term from a union select term from b)
            select term from terms t where not exists (select 1 from terms o where o.term <> t.term and contains(t.term, o.term)) and term <> ''""",
        "term_counters": f"""with t as (select {strip('term')} as term from (select unnest(regexp_split_to_array(text, '[ .]')) as term from benchmark))
            select count(*) filter (term <> '') as valid_terms, count(*) filter (term = '') as skipped_terms,
            count(distinct case when term <> '' then term end) as dictionary_size from t""",
        "keyword_match": f"with {DOCS} select doc_id, cast({any_of('c', INFO_KEYWORDS)} as integer) as has_info_keywords from docs",
        "entity_gazetteer_flag": f"""with {GAZETTEER}, hits as (select distinct doc_id from documents, names where contains(text, name))
            select doc_id, cast(doc_id in (select doc_id from hits) as integer) as has_info_entities from documents""",
        "entity_unpivot": f"with {LINES} select l_orderkey, idx, id, label from labels_of",
        "nested_entities": """select l_orderkey, cast(row_number() over (partition by l_orderkey
            order by l_partkey, l_returnflag, l_linenumber, l_suppkey) as integer) as idx, l_partkey as id, l_returnflag as label,
            cast(l_linenumber as bigint) as start, l_suppkey as "end" from lineitem""",
        "span_extract": f"with {NAMED} select doc_id, idx, name from named where name <> ''",
        "span_quality": f"""with {NAMED} select (select count(*) from documents) as rows_processed,
            (select count(*) from spans where lower(label) = 'malware') as malware_mentions,
            (select count(*) from spans where lower(label) = 'malware' and not {VALID}) as invalid_spans,
            (select count(distinct name) from named where name <> '') as distinct_names""",
        "dictionary_build": f"with {built(4)} select term from terms",
        "alias_clean": alias_rows("conversations", "conv_id, turn", "text"),
        "alias_union": f"with {ALIASES} select term from base union select term from aliases",
        "alias_quality": f"""with {ALIASES} select (select count(*) from asked) as asked,
            (select count(distinct name) from found where content is not null) as successful,
            (select count(*) from asked where name not in (select name from answers)) as failed,
            (select count(*) from aliases where term not in (select term from base)) as newly_added""",
        "dictionary_store": f"with {runs(4)} select term from terms",
        "csv_scan": "select conv_id, turn, case when role = 'user' then null else role end as role, text from conversations",
        "relations_parse": """select l_orderkey, cast(row_number() over (partition by l_orderkey
            order by l_linenumber, l_partkey, l_suppkey) - 1 as integer) as pos, l_partkey as from_id, l_suppkey as to_id from lineitem""",
        "total_edges": "select l_orderkey, cast(count(*) as integer) as graph_total_edges from lineitem group by all",
        "node_degree": f"with {SIMPLE} select l_orderkey, node, degree from degrees",
        "labelled_nodes": f"with {SIMPLE} select l_orderkey, node from labelled",
        "graph_features_rows": f"with {SIMPLE} select * from ({GRAPH}) where graph_total_edges > 0",
        "graph_features_edges": f"with {SIMPLE} {GRAPH}",
        "derive_label": f"with {LINES}, {TARGETS} select l_orderkey, true_label from targets",
        "label_map": """select p_partkey, cast(p_brand = 'Brand#13' as integer) as label from part""",
        "value_shares": "select event_type as value, count(*) as n, round(count(*) / sum(count(*)) over (), 9) as share from events group by all",
        "numeric_summary": summary("events", "value") + " union all " + summary("events", "user_id"),
        "class_counts": "select toxic as value, count(*) as n, count(*) over () as classes from labels group by all",
        "stratified_split": f"""with {SIZES}, placed as (select doc_id, toxic, row_number() over (partition by toxic order by {HASH}, doc_id) as place from labels)
            select doc_id, toxic, place <= test as is_test from placed join sizes using (toxic)""",
        "stratified_split_counts": f"""with {SIZES} select toxic, true as is_test, test as n from sizes
            union all select toxic, false, n - test from sizes""",
        "plain_split_counts": """with t as (select count(*) as n, cast(ceil(count(*) * 0.2) as bigint) as test from labels)
            select true as is_test, test as n from t union all select false, n - test from t""",
        "scale_features": f"select l_orderkey, l_linenumber, l_partkey, {scaled('l_quantity')}, {scaled('l_tax')} from lineitem",
        "class_weights": """select toxic as label, count(*) as n,
            round(sum(count(*)) over () / (count(*) over () * count(*)), 9) as weight from labels group by all""",
        "confusion_matrix": f"with {MATRIX} select 0 as true_label, tn as pred_0, fp as pred_1 from m union all select 1, fn, tp from m",
        "classification_report": REPORT,
        "leakage_check": f"""with {SIMPLE}, {LINES}, {TARGETS}, g as ({GRAPH})
            select count(*) filter (true_label = 0 and graph_max_malware_degree = 0) as tn,
              count(*) filter (true_label = 0 and graph_max_malware_degree > 0) as fp,
              count(*) filter (true_label = 1 and graph_max_malware_degree = 0) as fn,
              count(*) filter (true_label = 1 and graph_max_malware_degree > 0) as tp
            from g join targets using (l_orderkey)""",
        "logistic_fit": f"""with flagged_lines as (select *, cast(l_returnflag = 'R' as integer) as y from lineitem),
            {newton('fit', 'flagged_lines', ['l_quantity', 'l_discount', 'l_tax'], 'y')}
            select unnest(['l_quantity', 'l_discount', 'l_tax', 'intercept']) as feature, round(unnest([b0, b1, b2, b3]), 7) as weight from fit""",
        "three_way_report": reported(f"feats as ({FEATURES}), {compared('feats')}"),
        "detection_run": reported(RUN),
        "result_document": f"""with {RUN}, cells as (select {', '.join(
            f"max({c}) filter (model = '{d}') as {d}_{c}" for d in ('dictionary_only', 'text_flags', 'graph') for c in ('tn', 'fp', 'fn', 'tp'))} from m)
            select (select count(*) from documents) as initial_rows, (select count(*) from splitted where not is_test) as train_rows,
              (select count(*) from splitted where is_test) as test_rows, (select count(*) from ({TERM_LIST})) as terms,
              cast(4 as bigint) as min_term_length, '{','.join(GRAPH_FEATURES)}' as features, * from cells""",
        "one_class_run": f"""with {DOCS}, {LONG_WORDS}, {SPANS},
            quiet as (select * from docs where doc_id not in (select doc_id from spans where lower(label) = 'malware')),
            placed as (select doc_id, c, row_number() over (order by {HASH}, doc_id) as place from quiet),
            test as (select * from placed where place <= (select ceil(count(*) * 0.2) from quiet)),
            hits as (select distinct doc_id from test, terms where contains(c, term))
            select cast(2 as integer) as models_skipped, count(*) - (select count(*) from hits) as tn, (select count(*) from hits) as fp,
              cast(0 as bigint) as fn, cast(0 as bigint) as tp, count(*) as test_rows from test""",
        "detection_features": FEATURES,
        "features_without_entities": f"select * replace (0 as has_info_entities) from ({FEATURES})",
        "recognizer_flag": "select doc_id, cast(contains(text, 'License') as integer) as has_info_entities from documents",
        "row_guards": "select count(*) as rows, count(*) as numbers from documents",
        "value_shares_missing": """select cast(floor(value / 10) as double) as value, count(*) as n, round(count(*) / sum(count(*)) over (), 9) as share
            from events where user_id % 7 <> 0 and user_id % 5 <> 0 group by 1""",
        "stream_match_words": f"""with {DOCS}, {LONG_WORDS}, hits as (select distinct doc_id from docs, terms where contains(c, term))
            select doc_id, cast(doc_id in (select doc_id from hits) as integer) as malware_flag,
            cast({any_of('c', INFO_KEYWORDS)} as integer) as has_info_keywords from docs""",
        "stream_match": f"""with {DOCS}, {runs(4)}, hits as (select distinct doc_id from docs, terms where contains(c, term))
            select doc_id, cast(doc_id in (select doc_id from hits) as integer) as malware_flag,
            cast({any_of('c', INFO_KEYWORDS)} as integer) as has_info_keywords from docs""",
    }
