"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from quillset.catalog.queries import DATE_RANGE
from quillset.functions.stemming import (
    DERIVED_SUFFIXES,
    DOUBLE_CONSONANT,
    ENDING_SUFFIXES,
    IRREGULAR,
    MEASURE_IS_1,
    MEASURE_OVER_0,
    MEASURE_OVER_1,
    RESIDUAL_SUFFIXES,
    SHORT_SYLLABLE,
    TO_VOWEL,
    any_suffix,
)
from quillset.functions.text import METHODS_PROMPT, PLACEHOLDERS, RESULTS_PROMPT, WHITESPACE_CHARS

# RE2 spells code points with braces.
SPACES = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WORD = r"[\p{L}\p{N}_]"


def strip(x: str) -> str:
    return f"trim({x}, '{WHITESPACE_CHARS}')"


def clean(x: str) -> str:
    collapsed = f"regexp_replace({x}, '[{SPACES}]+', ' ', 'g')"
    cited = rf"regexp_replace({collapsed}, '\\cite\{{[^}}]+\}}', '', 'g')"
    return rf"trim(regexp_replace({cited}, '\$[^$]+\$', '', 'g'))"


def words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '{WORD}+'))::int"


def space_words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[^{SPACES}]+'))::int"


def sentences(x: str) -> str:
    parts = f"list_transform(regexp_split_to_array({x}, '[.!?]+'), lambda s: {strip('s')})"
    return f"list_filter({parts}, lambda s: s <> '')"


def joined(parts: str) -> str:
    return f"CASE WHEN len({parts}) > 0 THEN array_to_string({parts}, '. ') || '.' ELSE '' END"


def extract(x: str) -> str:
    return joined(f"{sentences(x)}[1:3]")


def valid(x: str) -> str:
    placeholder = " OR ".join(f"contains(lower({x}), '{p}')" for p in PLACEHOLDERS)
    return f"coalesce({strip(x)} <> '' AND {words(x)} BETWEEN 10 AND 100 AND NOT ({placeholder}), false)"


RAW = """raw AS (
  SELECT doc_id AS arxiv_id, split_part(text, chr(10), 1) AS title, text AS abstract, source, lang,
         strftime(date '2020-01-01' + (doc_id % 1000)::int, '%Y-%m-%d') AS published
  FROM documents)"""

DATED = """dated AS (
  SELECT * REPLACE (CASE
      WHEN arxiv_id % 7 = 0 THEN published || 'T10:30:00Z'
      WHEN arxiv_id % 7 = 1 THEN published || 'T22:30:00-05:00'
      WHEN arxiv_id % 7 = 2 THEN published || ' 08:15:30'
      WHEN arxiv_id % 7 = 3 THEN published || ' (v2)'
      WHEN arxiv_id % 7 = 4 THEN substr(published, 1, 7)
      WHEN arxiv_id % 7 = 5 AND arxiv_id % 2 = 0 THEN NULL
      ELSE published END AS published),
    CASE
      WHEN arxiv_id % 7 = 0 THEN published::timestamp + interval '10 hours 30 minutes'
      WHEN arxiv_id % 7 = 1 THEN published::timestamp + interval '27 hours 30 minutes'
      WHEN arxiv_id % 7 = 2 THEN published::timestamp + interval '8 hours 15 minutes 30 seconds'
      WHEN arxiv_id % 7 = 4 OR (arxiv_id % 7 = 5 AND arxiv_id % 2 = 0) THEN NULL
      ELSE published::timestamp END AS moment
  FROM raw)"""

CLEANED = f"""cleaned AS (SELECT * REPLACE ({clean('abstract')} AS abstract) FROM raw),
papers AS (
  SELECT arxiv_id AS id, title, abstract, {words('abstract')} AS abs_words, source, lang, published
  FROM cleaned WHERE {strip('title')} <> '' AND abstract <> '')"""

PAPERS = f"WITH {RAW}, {CLEANED}"

LATEST = """latest AS (
  SELECT * FROM papers WHERE abs_words >= 60
  QUALIFY row_number() OVER (PARTITION BY title ORDER BY published DESC NULLS FIRST, id DESC) = 1)"""

SPLIT = """sized AS (
  SELECT *, ceil(held * 0.5::double)::bigint AS test, n - held AS train
  FROM (SELECT count(*) AS n, ceil(count(*) * 0.2::double)::bigint AS held FROM latest)),
ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42/' || length(id::varchar) || ':' || id || coalesce(length(title) || ':' || title, '-'))) AS r FROM latest),
split_papers AS (
  SELECT r.* EXCLUDE (r), CASE WHEN r.r <= s.train THEN 'train' WHEN r.r <= s.n - s.test THEN 'val' ELSE 'test' END AS split
  FROM ranked r CROSS JOIN sized s)"""

SPLIT_PAPERS = f"{PAPERS}, {LATEST}, {SPLIT}"


def label(source: str) -> str:
    return f"""drafted AS (
  SELECT *, CASE WHEN length({strip('abstract')}) >= 50 THEN {extract('abstract')} END AS draft FROM {source}),
summarised AS (SELECT *, lang AS language, CASE WHEN {valid('draft')} THEN {strip('draft')} END AS summary FROM drafted),
labelled AS (
  SELECT *,
    CASE WHEN summary IS NOT NULL THEN nullif({strip(extract('abstract'))}, '') END AS methods,
    CASE WHEN summary IS NOT NULL THEN nullif({strip(extract('abstract'))}, '') END AS results
  FROM summarised)"""


LABELLED = f"{PAPERS}, {label('papers')}"


def model_words(x: str) -> str:
    return f"' ' || array_to_string(regexp_extract_all({x}, '[^{SPACES}]+')[1:40], ' ')"


PAIRS = f"""parted AS (SELECT doc_id + 1 AS id, text, {sentences('text')} AS parts FROM documents),
pairs AS (
  SELECT parted.id, coalesce(d.text, '') AS prediction, {joined('parts[1:3]')} AS reference
  FROM parted LEFT JOIN documents d ON d.doc_id = parted.id),
tokens AS (
  SELECT id, regexp_extract_all(lower(prediction), '[a-z0-9]+') AS p, regexp_extract_all(lower(reference), '[a-z0-9]+') AS r
  FROM pairs)"""


def ngram_list(side: str, n: int) -> str:
    if n == 1:
        return side
    return f"list_transform(range(1, len({side})), lambda i: {side}[i] || ' ' || {side}[i + 1])"


def rouge(n: int, metric: str, tokens: str = "tokens") -> str:
    """CTEs ending in one named after the metric."""
    m = metric
    return f"""{m}_p AS (
  SELECT id, g, count(*) AS c FROM (SELECT id, unnest({ngram_list('p', n)}) AS g FROM {tokens}) GROUP BY ALL),
{m}_r AS (
  SELECT id, g, count(*) AS c FROM (SELECT id, unnest({ngram_list('r', n)}) AS g FROM {tokens}) GROUP BY ALL),
{m}_o AS (SELECT id, sum(least(a.c, b.c))::double AS o FROM {m}_p a JOIN {m}_r b USING (id, g) GROUP BY id),
{m}_f AS (
  SELECT id, coalesce(o, 0) AS o, greatest(len(p) - {n - 1}, 0)::double AS np, greatest(len(r) - {n - 1}, 0)::double AS nr
  FROM {tokens} LEFT JOIN {m}_o USING (id)),
{m} AS (
  SELECT id, '{m}' AS metric,
    CASE WHEN np > 0 THEN o / np ELSE 0 END AS "precision", CASE WHEN nr > 0 THEN o / nr ELSE 0 END AS recall,
    CASE WHEN o > 0 THEN 2 * o / (np + nr) ELSE 0 END AS f1
  FROM {m}_f)"""


def token_lines(x: str) -> str:
    found = f"list_transform(string_split({strip(x)}, chr(10)), lambda l: regexp_extract_all(lower(l), '[a-z0-9]+'))"
    return f"list_filter({found}, lambda l: len(l) > 0)"


LINES = f"""lined AS (
  SELECT id, {token_lines('prediction')} AS p, {token_lines('reference')} AS r FROM pairs)"""


def stemmed_lines(side: str) -> str:
    return f"list_transform({side}, lambda l: list_transform(l, lambda x: coalesce(m[x], x)))"


def subsequence_scores(metric: str, overlaps: str, tokens: str) -> str:
    return f"""{metric}_s AS (
  SELECT id, coalesce(o, 0)::double AS o, len(p)::double AS np, len(r)::double AS nr
  FROM (SELECT id, {tokens}) LEFT JOIN {overlaps} USING (id)),
{metric} AS (
  SELECT id, '{metric}' AS metric, CASE WHEN np > 0 THEN o / np ELSE 0 END AS "precision",
    CASE WHEN nr > 0 THEN o / nr ELSE 0 END AS recall, CASE WHEN o > 0 THEN 2 * o / (np + nr) ELSE 0 END AS f1
  FROM {metric}_s)"""


def rouge_l(tokens: str) -> str:
    """The common subsequence as the longest rising one among the places where tokens match."""
    return f"""rougeL_p AS (SELECT id, unnest(p) AS t, unnest(range(len(p))) AS i FROM {tokens}),
rougeL_r AS (SELECT id, unnest(r) AS t, unnest(range(len(r))) AS j FROM {tokens}),
rougeL_m AS (SELECT id, list([j] ORDER BY i, j DESC) AS m FROM rougeL_p JOIN rougeL_r USING (id, t) GROUP BY id),
rougeL_o AS (
  SELECT id, len(list_reduce(m, lambda a, b: list_concat(
      list_concat(list_filter(a, lambda x: x < b[1]), b), list_filter(a, lambda x: x >= b[1])[2:]),
    CAST([] AS BIGINT[]))) AS o
  FROM rougeL_m),
{subsequence_scores('rougeL', 'rougeL_o', f'p, r FROM {tokens}')}"""


def rouge_lsum(lines: str) -> str:
    """The whole table of each pair of lines, traced from its end; what any line of the prediction covers counts once."""
    row = """list_reduce(list_transform(range(1, len(r) + 1), lambda j: [j]), lambda a, j: list_append(a, greatest(
      a[-1], g[-1][j[1] + 1], CASE WHEN r[j[1]] = p[k[1][1]] THEN g[-1][j[1]] + 1 ELSE 0 END)), CAST([0] AS BIGINT[]))"""
    return f"""sum_x AS (SELECT id, r AS rs, unnest(p) AS p FROM {lines}),
sum_y AS (SELECT id, p, unnest(rs) AS r, unnest(range(len(rs))) AS y FROM sum_x),
sum_grid AS (
  SELECT id, y, p, r, list_reduce(list_transform(range(1, len(p) + 1), lambda k: [[k]]),
    lambda g, k: list_append(g, {row}), [list_transform(range(len(r) + 1), lambda z: CAST(0 AS BIGINT))]) AS g
  FROM sum_y WHERE list_has_any(p, r)),
sum_trace AS (
  SELECT id, y, r, list_reduce(list_transform(range(len(p) + len(r)), lambda z: [z]), lambda s, z: CASE
      WHEN s[1] = 0 OR s[2] = 0 THEN s
      WHEN r[s[1]] = p[s[2]] THEN list_append(list_concat([s[1] - 1, s[2] - 1], s[3:]), s[1])
      WHEN g[s[2]][s[1] + 1] > g[s[2] + 1][s[1]] THEN list_concat([s[1], s[2] - 1], s[3:])
      ELSE list_concat([s[1] - 1, s[2]], s[3:]) END, [len(r), len(p)])[3:] AS hits
  FROM sum_grid),
sum_covered AS (SELECT DISTINCT id, y, place, r[place] AS t FROM (SELECT *, unnest(hits) AS place FROM sum_trace)),
sum_predicted AS (SELECT id, t, count(*) AS n FROM (SELECT id, unnest(flatten(p)) AS t FROM {lines}) GROUP BY id, t),
sum_o AS (
  SELECT id, sum(least(c, n)) AS o
  FROM (SELECT id, t, count(*) AS c FROM sum_covered GROUP BY id, t) JOIN sum_predicted USING (id, t) GROUP BY id),
{subsequence_scores('rougeLsum', 'sum_o', f'flatten(p) AS p, flatten(r) AS r FROM {lines}')}"""


def rounded_scores(metric: str) -> str:
    return f"""SELECT id, metric, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1
FROM {metric}"""


def _map(pairs: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in pairs.items()) + "}"


def _has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, '{pattern}')"


def _suffix_step(name: str, source: str, suffixes, replacement: str, condition: str) -> str:
    """Replace the longest suffix of a list if its stem meets the condition."""
    return f"""{name}_s AS (
  SELECT token, w, regexp_extract(w, '{any_suffix(suffixes)}', 1) AS s, left(w, length(w) - length(s)) AS stem FROM {source}),
{name} AS (
  SELECT token, CASE WHEN s <> '' AND {condition} THEN stem || {replacement} ELSE w END AS w FROM {name}_s)"""


STEMS = f"""vocabulary AS (SELECT DISTINCT unnest(p || r) AS token FROM tokens),
plural AS (
  SELECT token, CASE WHEN {_has('token', '^.ies$')} THEN left(token, 3)
    ELSE regexp_replace(regexp_replace(token, '(ss|i)es$', '\\1'), '([^s])s$', '\\1') END AS w
  FROM vocabulary WHERE length(token) > 3),
participle AS (
  SELECT token, w, regexp_replace(w, '(?:ed|ing)$', '') AS stem,
    {_has('w', TO_VOWEL + '.*(?:ed|ing)$')} AND NOT {_has('w', '(?:ied|eed)$')} AS cut
  FROM plural),
repaired AS (
  SELECT token, CASE
      WHEN {_has('w', '^.ied$')} THEN left(w, length(w) - 1)
      WHEN {_has('w', 'ied$')} THEN left(w, length(w) - 2)
      WHEN {_has('w', 'eed$')} THEN CASE WHEN {_has('w', MEASURE_OVER_0 + '.*eed$')} THEN left(w, length(w) - 1) ELSE w END
      WHEN NOT cut THEN w
      WHEN {_has('stem', '(?:at|bl|iz)$')} THEN stem || 'e'
      WHEN {_has('stem', DOUBLE_CONSONANT)} THEN left(stem, length(stem) - 1)
      WHEN {_has('stem', SHORT_SYLLABLE)} THEN stem || 'e'
      ELSE stem END AS w
  FROM participle),
final_y AS (SELECT token, regexp_replace(w, '^(.+[^aeiouy])y$', '\\1i') AS w FROM repaired),
adverb AS (
  SELECT token, CASE WHEN {_has('w', MEASURE_OVER_0 + '.*alli$')} THEN left(w, length(w) - 2) ELSE w END AS w FROM final_y),
{_suffix_step('derived', 'adverb', DERIVED_SUFFIXES, f"{_map(DERIVED_SUFFIXES)}[s]",
              _has("CASE WHEN s = 'logi' THEN stem || 'l' ELSE stem END", MEASURE_OVER_0))},
{_suffix_step('ending', 'derived', ENDING_SUFFIXES, f"{_map(ENDING_SUFFIXES)}[s]", _has('stem', MEASURE_OVER_0))},
{_suffix_step('residual', 'ending', RESIDUAL_SUFFIXES, "''",
              f"{_has('stem', MEASURE_OVER_1)} AND (s <> 'ion' OR {_has('stem', '[st]$')})")},
final_e AS (
  SELECT token, CASE WHEN w LIKE '%e' AND ({_has('left(w, length(w) - 1)', MEASURE_OVER_1)}
      OR ({_has('left(w, length(w) - 1)', MEASURE_IS_1)} AND NOT {_has('left(w, length(w) - 1)', SHORT_SYLLABLE)}))
    THEN left(w, length(w) - 1) ELSE w END AS w
  FROM residual),
double_l AS (
  SELECT token, CASE WHEN w LIKE '%ll' AND {_has('left(w, length(w) - 1)', MEASURE_OVER_1)}
    THEN left(w, length(w) - 1) ELSE w END AS w
  FROM final_e),
stems AS (SELECT token, coalesce({_map(IRREGULAR)}[token], w) AS w FROM double_l),
exploded AS (
  SELECT id, 'p' AS side, unnest(p) AS token FROM tokens UNION ALL SELECT id, 'r', unnest(r) FROM tokens),
stem_lists AS (
  SELECT id, list(coalesce(w, token)) FILTER (side = 'p') AS p, list(coalesce(w, token)) FILTER (side = 'r') AS r
  FROM exploded LEFT JOIN stems USING (token) GROUP BY id),
stemmed AS (
  SELECT id, coalesce(s.p, []::varchar[]) AS p, coalesce(s.r, []::varchar[]) AS r
  FROM tokens LEFT JOIN stem_lists s USING (id))"""

FIRST_DAY, LAST_DAY = DATE_RANGE.split("..")


def mentions(term: str) -> str:
    found = "|".join([term])
    pattern = rf"(^|[^\p{{L}}\p{{N}}_])({found})([^\p{{L}}\p{{N}}_]|$)"
    return f"(regexp_matches(lower(title), '{pattern}') OR regexp_matches(lower(abstract), '{pattern}'))"


def word_lengths(x: str) -> str:
    return f"list_transform(regexp_extract_all({x}, '[^{SPACES}]+'), lambda w: length(w))"


def word_tokens(x: str) -> str:
    return rf"regexp_extract_all({x}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]')"


def examples(tokens: Callable[[str], str]) -> str:
    """Truncated inputs and targets."""
    return f"""{LABELLED}, tokenized AS (
  SELECT id, {tokens('abstract')} AS i, {tokens("coalesce(summary, '')")} AS t FROM labelled)
SELECT id, array_to_string(i[1:512], '|') AS input_ids, array_to_string(t[1:128], '|') AS labels,
  least(len(i), 512)::int AS input_len, least(len(t), 128)::int AS target_len, len(i) > 512 OR len(t) > 128 AS truncated
FROM tokenized"""


def hits(k: int) -> str:
    """The nearest vectors of every twentieth one, by a comparison with all."""
    return f"""WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::double) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x <> 0)) > 0),
compared AS (
  SELECT q.vec_id AS query_id, r.vec_id AS id, round(list_cosine_similarity(q.v, r.v), 9) AS similarity
  FROM vectors q JOIN vectors r ON q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id)::int AS rank FROM compared),
hits AS (SELECT * FROM ranked WHERE rank <= {k})"""


ORACLES: dict[str, str] = {
    "scan_jsonl": f"""WITH {RAW}
SELECT arxiv_id::varchar AS arxiv_id, title, abstract, source || '|' || lang AS categories, published,
  NULL::varchar AS pdf_url FROM raw""",
    "roundtrip_jsonl": f"""{PAPERS}
SELECT id::varchar AS id, title, abstract, abs_words, source || '|' || lang AS categories,
  count(*) OVER () AS rows_written FROM papers""",
    "roundtrip_parquet": f"{SPLIT_PAPERS} SELECT id, title, abstract, published, split FROM split_papers",
    "load_splits": f"""{SPLIT_PAPERS}, {label('split_papers')}
SELECT id::varchar AS id, abs_words, summary, split FROM labelled WHERE summary IS NOT NULL""",
    "scan_atom": f"""WITH {RAW}
SELECT arxiv_id::varchar AS arxiv_id, replace({strip('title')}, chr(10), ' ') AS title,
  replace({strip('abstract')}, chr(10), ' ') AS abstract, source || '|' || lang AS authors,
  source || '|' || lang AS categories, published || 'T00:00:00Z' AS published,
  CASE WHEN arxiv_id % 2 = 0 THEN 'http://papers.example.org/pdf/' || arxiv_id END AS pdf_url FROM raw""",
    "build_papers": f"""{PAPERS}
SELECT id, title, abstract, abs_words, source || '|' || lang AS categories, published, NULL::varchar AS pdf_url
FROM papers""",
    "normalize_source": f"""WITH {RAW}, {DATED}
SELECT arxiv_id, CASE WHEN arxiv_id % 5 <> 0 THEN {strip('title')} ELSE '' END AS title,
  CASE WHEN arxiv_id % 11 <> 0 THEN {strip('abstract')} ELSE '' END AS abstract,
  CASE WHEN arxiv_id % 3 <> 0 THEN source || '|' || lang ELSE '' END AS authors,
  CASE WHEN arxiv_id % 13 <> 0 THEN source || '|' || lang ELSE '' END AS categories,
  regexp_replace(published, '(T[0-9:]+)(Z|-05:00)$', '\\1') AS published FROM dated""",
    "filter_min_words": f"{PAPERS} SELECT id, abs_words FROM papers WHERE abs_words >= 60",
    "filter_date_range": f"""{PAPERS}, {DATED}
SELECT p.id, d.published, p.abs_words FROM papers p JOIN dated d ON d.arxiv_id = p.id
WHERE d.moment >= timestamp '{FIRST_DAY}' AND d.moment <= timestamp '{LAST_DAY}'""",
    "dedup_latest": f"""{PAPERS}
SELECT id, title, abs_words, published FROM papers
QUALIFY row_number() OVER (PARTITION BY title ORDER BY published DESC NULLS FIRST, id DESC) = 1""",
    "split_assign": f"{SPLIT_PAPERS} SELECT id, abs_words, published, split FROM split_papers",
    "split_sizes": f'{SPLIT_PAPERS} SELECT split, count(*) AS "rows" FROM split_papers GROUP BY split',
    "prep_stats": f"""{SPLIT_PAPERS}
SELECT (SELECT count(*) FROM raw) AS input_rows, (SELECT count(*) FROM papers) AS raw, count(*) AS after_filters,
  count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val,
  count(*) FILTER (split = 'test') AS test FROM split_papers""",
    "search_topn": f"""WITH {RAW}
SELECT arxiv_id, title, published, source || '|' || lang AS categories FROM raw
WHERE (source IN ('src1', 'src2', 'src3', 'de') OR lang IN ('src1', 'src2', 'src3', 'de'))
  AND (({mentions('the')} AND {mentions('with')}) OR {mentions('les')}
    OR {mentions(f'hyphenated[{SPACES}]+word')} OR {mentions('und')})
ORDER BY published DESC NULLS LAST, arxiv_id LIMIT 200""",
    "clean_text": f"SELECT doc_id, {clean('text')} AS abstract FROM documents",
    "word_count": f"SELECT doc_id, {words('text')} AS words, {space_words('text')} AS whitespace_words FROM documents",
    "compression": f"""WITH summarised AS (SELECT doc_id, text, {extract('text')} AS summary FROM documents)
SELECT doc_id, round(CASE WHEN {space_words('summary')} > 0 THEN {space_words('text')} / {space_words('summary')}::double
  ELSE 0.0 END, 6) AS compression FROM summarised""",
    "extractive_summary": f"SELECT doc_id, {extract('text')} AS summary FROM documents",
    "parse_published": f"""WITH {RAW}, {DATED}
SELECT arxiv_id, published, strftime(moment, '%Y-%m-%d %H:%M:%S') AS moment FROM dated""",
    "id_from_url": "SELECT page_id, string_split(url, '/')[-1] AS id FROM pages",
    "build_prompts": f"""{PAPERS}
SELECT id, '{METHODS_PROMPT}' || abstract AS methods_prompt, '{RESULTS_PROMPT}' || abstract AS results_prompt
FROM papers""",
    "summary_guard": f"SELECT doc_id, length({strip('text')}) >= 50 AS long_enough FROM documents",
    "validate_summary": f"""{PAPERS}, summarised AS (SELECT id, {extract('abstract')} AS summary FROM papers)
SELECT id, {valid('summary')} AS valid FROM summarised""",
    "label_papers": f"{LABELLED} SELECT id, abs_words, summary FROM labelled",
    "label_conditional": f"{LABELLED} SELECT id, methods, results FROM labelled",
    "label_with_model": f"""{PAPERS},
drafted AS (
  SELECT *, contains(abstract, '?') AND length({strip('abstract')}) >= 50 AS failed,
    CASE WHEN length({strip('abstract')}) >= 50 AND NOT contains(abstract, '?')
      THEN {model_words('abstract')} END AS draft
  FROM papers),
summarised AS (SELECT *, CASE WHEN {valid('draft')} THEN {strip('draft')} END AS summary FROM drafted)
SELECT id, summary,
  CASE WHEN summary IS NOT NULL THEN {strip(model_words(f"('{METHODS_PROMPT}' || abstract)"))} END AS methods,
  CASE WHEN summary IS NOT NULL THEN {strip(model_words(f"('{RESULTS_PROMPT}' || abstract)"))} END AS results,
  CASE WHEN failed THEN 'ValueError: cannot answer questions' END AS label_error
FROM summarised""",
    "fallback_fill": f"""{LABELLED}
SELECT id, CASE WHEN summary IS NULL OR summary = '' THEN {extract('abstract')} ELSE summary END AS summary FROM labelled""",
    "filter_labelled": f"""{LABELLED}
SELECT id, summary, lang AS split FROM labelled WHERE summary IS NOT NULL AND {strip('summary')} <> ''""",
    "filter_labelled_stats": f"""{LABELLED}
SELECT lang AS split, count(*) AS total, count(*) FILTER ({strip('summary')} <> '') AS kept FROM labelled GROUP BY lang""",
    "attach_labels": f"""{PAPERS}
SELECT id, abs_words, quality, toxic FROM papers LEFT JOIN labels ON doc_id = id""",
    "generation_stats": f"""{LABELLED},
counted AS (SELECT lang AS split, summary, methods, results FROM labelled
  UNION ALL SELECT 'all' AS split, summary, methods, results FROM labelled),
named AS (SELECT DISTINCT split FROM counted UNION SELECT unnest(['all', 'de', 'en', 'xx']))
SELECT named.split, count(counted.split) AS total_papers, count(*) FILTER (summary <> '') AS valid_summaries,
  count(*) FILTER (methods <> '') AS valid_methods, count(*) FILTER (results <> '') AS valid_results,
  round(coalesce(avg({words('summary')}) FILTER (summary <> ''), 0), 6) AS avg_summary_length,
  round(coalesce(count(*) FILTER (summary <> '') / nullif(count(counted.split), 0)::double, 0), 6) AS summary_success_rate
FROM named LEFT JOIN counted ON counted.split = named.split GROUP BY named.split""",
    "multitask_examples": f"""{LABELLED}
SELECT id, 'summarization' AS task, abstract AS input, summary AS target, 1.0::double AS weight FROM labelled
  WHERE summary IS NOT NULL
UNION ALL SELECT id, 'method_extraction', 'extract methods: ' || abstract, methods, 0.5 FROM labelled
  WHERE methods IS NOT NULL
UNION ALL SELECT id, 'result_extraction', 'extract results: ' || abstract, results, 0.5 FROM labelled
  WHERE results IS NOT NULL""",
    "token_lengths": f"""{LABELLED},
sizes AS (
  SELECT lang AS split, 'input' AS side, 512 AS most, len({word_tokens('abstract')}) AS n FROM labelled
  UNION ALL SELECT lang, 'target', 128, len({word_tokens("coalesce(summary, '')")}) FROM labelled),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY split, side ORDER BY n) AS r, count(*) OVER (PARTITION BY split, side) AS c
  FROM sizes)
SELECT split, side, count(*) AS examples, round(avg(n), 6) AS mean_length,
  {', '.join(f'(min(n) FILTER (r >= ceil(c * {p} / 100.0)))::int AS p{p}' for p in (50, 90, 95, 99))},
  max(n)::int AS longest, count(*) FILTER (n > most) AS truncated,
  round(count(*) FILTER (n > most) / count(*)::double, 6) AS truncation_rate
FROM placed GROUP BY split, side""",
    "repetition_flag": f"""WITH worded AS (
  SELECT doc_id, regexp_extract_all(lower(text), '{WORD}+') AS w FROM documents),
grams AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM worded)),
again AS (
  SELECT doc_id, min(i) AS first_repeat
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, g ORDER BY i) AS r FROM grams) WHERE r > 1 GROUP BY doc_id)
SELECT doc_id, first_repeat::int AS first_repeat, first_repeat IS NOT NULL AS repeats
FROM documents LEFT JOIN again USING (doc_id)""",
    "knn_topk": f"{hits(10)} SELECT query_id, rank, id, round(similarity, 6) AS similarity FROM hits",
    "rag_context": f"""{hits(5)},
worded AS (
  SELECT query_id, rank, id, coalesce(regexp_extract_all(text, '[^{SPACES}]+'), []) AS w
  FROM hits LEFT JOIN documents ON doc_id = id),
cut AS (
  SELECT *, w[1:greatest(400 - coalesce(sum(len(w)) OVER (
    PARTITION BY query_id ORDER BY rank, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)] AS taken
  FROM worded)
SELECT query_id,
  coalesce(string_agg(array_to_string(taken, ' '), chr(10) || chr(10) ORDER BY rank, id) FILTER (len(taken) > 0), '') AS context,
  (count(*) FILTER (len(taken) > 0))::int AS n_texts, sum(len(taken))::bigint AS n_words,
  sum(len(taken)) < sum(len(w)) AS truncated
FROM cut GROUP BY query_id""",
    "truncate_tokens": examples(word_tokens),
    "truncate_custom_tokens": examples(word_lengths),
    "rouge1": f"WITH {PAIRS}, {rouge(1, 'rouge1')} {rounded_scores('rouge1')}",
    "rouge2": f"WITH {PAIRS}, {rouge(2, 'rouge2')} {rounded_scores('rouge2')}",
    "rouge1_stem": f"WITH {PAIRS}, {STEMS}, {rouge(1, 'rouge1', 'stemmed')} {rounded_scores('rouge1')}",
    "rougeL": f"WITH {PAIRS}, {rouge_l('tokens')} {rounded_scores('rougeL')}",
    "rougeLsum": f"WITH {PAIRS}, {LINES}, {rouge_lsum('lined')} {rounded_scores('rougeLsum')}",
    "rouge_corpus_stem": f"""WITH {PAIRS}, {LINES}, {STEMS},
stem_map AS (SELECT map(list(token), list(w)) AS m FROM stems),
stem_lines AS (
  SELECT id, {stemmed_lines('p')} AS p, {stemmed_lines('r')} AS r FROM lined, stem_map),
stem_tokens AS (SELECT id, flatten(p) AS p, flatten(r) AS r FROM stem_lines),
{rouge(1, 'rouge1', 'stem_tokens')}, {rouge(2, 'rouge2', 'stem_tokens')},
{rouge_l('stem_tokens')}, {rouge_lsum('stem_lines')}
SELECT metric, round(avg(f1) * 100, 2) AS value FROM (
  SELECT * FROM rouge1 UNION ALL SELECT * FROM rouge2 UNION ALL SELECT * FROM rougeL UNION ALL SELECT * FROM rougeLsum)
GROUP BY metric""",
    "rouge_corpus": f"""WITH {PAIRS}, {rouge(1, 'rouge1')}, {rouge(2, 'rouge2')}
SELECT metric, round(avg(f1) * 100, 2) AS value FROM (SELECT * FROM rouge1 UNION ALL SELECT * FROM rouge2)
GROUP BY metric""",
}
