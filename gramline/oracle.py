"""DuckDB SQL for the registered queries, written on its own terms: plain windows, joins and sorts, no shared code."""

from __future__ import annotations

# The English stop words.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
it its itself they them their theirs themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or because as until while of at by for with
about against between into through during before after above below to from up down in out on off over under
again further then once here there when where why how all any both each few more most other some such no nor not
only own same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd
he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot
could here's how's let's ought that's there's what's when's where's who's why's would
"""
_STOP = ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS.split())

_DOCS = "SELECT doc_id AS row_id, text AS tweet, lang AS target FROM documents"
_SOURCES = "SELECT doc_id AS row_id, text AS tweet, source AS target FROM documents"
_MESSAGES = (
    "SELECT conv_id * (SELECT max(turn) + 1 FROM conversations) + turn AS row_id, text AS tweet, role AS target "
    "FROM conversations"
)
_JUDGED = """SELECT doc_id AS row_id, text AS tweet, CAST(quality AS VARCHAR) AS target
             FROM documents LEFT JOIN labels USING (doc_id)"""
_GUESSES = """SELECT a.doc_id AS row_id, a.lang AS target, b.lang AS predicted
              FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1"""


# n-grams and TF-IDF

_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _gram_lists(lo: int, hi: int, padded: str) -> str:
    """All n-grams of one padded word, in order, as a list."""
    return f"""flatten(list_transform(range({lo}, greatest({lo}, least({hi}, length({padded}))) + 1),
        lambda n: list_transform(range(1, greatest(1, length({padded}) - n + 1) + 1),
            lambda i: substring({padded}, i::INT, n::INT))))"""


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '{_SPACE}'), lambda w: w <> '')"


def _tf(rows: str, lo: int, hi: int, name: str = "tf") -> str:
    """CTEs ending in (row_id, gram, tf)."""
    return f"""{name}_words AS (SELECT row_id, unnest({_words("tweet")}) AS w FROM ({rows})),
    {name}_grams AS (SELECT row_id, unnest({_gram_lists(lo, hi, "' ' || w || ' '")}) AS gram FROM {name}_words),
    {name} AS (SELECT row_id, gram, CAST(count(*) AS BIGINT) AS tf FROM {name}_grams GROUP BY row_id, gram)"""


def _vocabulary(rows: str, lo: int, hi: int) -> str:
    return f"""{_tf(rows, lo, hi)},
    total AS (SELECT count(*) AS n FROM ({rows})),
    frequency AS (SELECT gram, count(*) AS df FROM tf GROUP BY gram),
    vocabulary AS (SELECT gram, df, ln((1 + n) / (1.0 + df)::DOUBLE) + 1 AS idf FROM frequency, total
                   WHERE df >= 5 AND df <= 0.6::DOUBLE * n)"""


def _weights(tf: str = "tf") -> str:
    return f"""raw AS (SELECT row_id, gram, tf * idf AS x FROM {tf} JOIN vocabulary USING (gram)),
    weights AS (SELECT row_id, gram, x / sqrt(sum(x * x) OVER (PARTITION BY row_id)) AS tfidf FROM raw)"""


def _tfidf(rows: str, lo: int, hi: int) -> str:
    return f"""WITH {_vocabulary(rows, lo, hi)}, {_weights()}
    SELECT row_id, gram, round(tfidf, 6) AS tfidf FROM weights"""


# Stemming, one CTE per step of the published algorithm

_STEP_2 = """ational ate, tional tion, enci ence, anci ance, abli able, entli ent, izer ize, ization ize, ation ate,
    ator ate, alism al, aliti al, alli al, fulness ful, ousli ous, ousness ous, iveness ive, iviti ive, biliti ble,
    bli ble, ogi og, fulli ful, lessli less, li """
_STEP_3 = "tional tion, ational ate, alize al, icate ic, iciti ic, ical ic, ful , ness , ative "
_STEP_4 = "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion"
_INVARIANT = """skis ski, skies sky, dying die, lying lie, tying tie, idly idl, gently gentl, ugly ugli, early earli,
    only onli, singly singl, sky sky, news news, howe howe, atlas atlas, cosmos cosmos, bias bias, andes andes"""
_SHORT = r"(^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])\z"


def _pairs(text: str) -> list[list[str]]:
    return [(pair.split() + [""])[:2] for pair in text.split(",")]


def _case(text: str, key: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _pairs(text)) + " END"


def _any(text: str) -> str:
    return "|".join(sorted((a for a, _ in _pairs(text)), key=len, reverse=True))


def _stems(tokens: str) -> str:
    """CTEs ending in stems (token, stem) for the distinct values of `token` in a CTE."""
    done = "('inning', 'outing', 'canning', 'herring', 'earring', 'proceed', 'exceed', 'succeed')"
    fours = "|".join(sorted(_STEP_4.split(), key=len, reverse=True))
    return rf"""s_lower AS (SELECT token, lower(token) AS low FROM (SELECT DISTINCT token FROM {tokens})),
    s_bare AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(low, '[’‘‛]', '''', 'g'), '^''', ''), '^y', 'Y') AS b
               FROM s_lower),
    s_mark AS (SELECT token, low, regexp_replace(b, '([aeiouy])y', '\1Y', 'g') AS w FROM s_bare),
    s_r1 AS (SELECT *, CASE WHEN regexp_matches(w, '^(gener|commun|arsen)')
                 THEN length(regexp_extract(w, '^(gener|commun|arsen)'))
                 WHEN regexp_matches(w, '[aeiouy][^aeiouy]') THEN length(regexp_extract(w, '^[^aeiouy]*[aeiouy]+[^aeiouy]'))
                 ELSE length(w) END AS r1 FROM s_mark),
    s_r2 AS (SELECT *, CASE WHEN regexp_matches(substring(w, r1 + 1), '[aeiouy][^aeiouy]')
                 THEN r1 + length(regexp_extract(substring(w, r1 + 1), '^[^aeiouy]*[aeiouy]+[^aeiouy]'))
                 ELSE length(w) END AS r2 FROM s_r1),
    s_0 AS (SELECT token, low, r1, r2, regexp_replace(w, '(''s''|''s|'')\z', '') AS w FROM s_r2),
    s_1a AS (SELECT token, low, r1, r2, CASE
                 WHEN w LIKE '%sses' THEN w[:-3]
                 WHEN w LIKE '%ied' OR w LIKE '%ies' THEN CASE WHEN length(w) > 4 THEN w[:-3] ELSE w[:-2] END
                 WHEN w LIKE '%us' OR w LIKE '%ss' THEN w
                 WHEN w LIKE '%s' AND regexp_matches(w[:-3], '[aeiouy]') THEN w[:-2]
                 ELSE w END AS w FROM s_0),
    s_1b_end AS (SELECT *, CASE WHEN w IN {done} THEN ''
                     ELSE regexp_extract(w, '(eedly|ingly|edly|eed|ing|ed)\z') END AS e FROM s_1a),
    s_1b_cut AS (SELECT *, substring(w, 1, length(w) - length(e)) AS p FROM s_1b_end),
    s_1b AS (SELECT token, low, r1, r2, CASE
                 WHEN e IN ('eed', 'eedly') THEN CASE WHEN length(p) >= r1 THEN p || 'ee' ELSE w END
                 WHEN e = '' OR NOT regexp_matches(p, '[aeiouy]') THEN w
                 WHEN regexp_matches(p, '(at|bl|iz)\z') THEN p || 'e'
                 WHEN regexp_matches(p, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)\z') THEN p[:-2]
                 WHEN length(p) <= r1 AND regexp_matches(p, '{_SHORT}') THEN p || 'e'
                 ELSE p END AS w FROM s_1b_cut),
    s_1c AS (SELECT token, low, r1, r2, w IN {done} AS done,
                 CASE WHEN regexp_matches(w, '(?s)^.+[^aeiouy][yY]\z') THEN w[:-2] || 'i' ELSE w END AS w FROM s_1b),
    s_2_end AS (SELECT *, regexp_extract(w, '({_any(_STEP_2)})\z') AS e FROM s_1c),
    s_2_cut AS (SELECT *, substring(w, 1, length(w) - length(e)) AS p FROM s_2_end),
    s_2 AS (SELECT token, low, r1, r2, done, CASE
                WHEN e = '' OR done OR length(p) < r1 THEN w
                WHEN e = 'ogi' AND NOT regexp_matches(p, 'l\z') THEN w
                WHEN e = 'li' AND NOT regexp_matches(p, '[cdeghkmnrt]\z') THEN w
                ELSE p || {_case(_STEP_2, "e")} END AS w FROM s_2_cut),
    s_3_end AS (SELECT *, regexp_extract(w, '({_any(_STEP_3)})\z') AS e FROM s_2),
    s_3_cut AS (SELECT *, substring(w, 1, length(w) - length(e)) AS p FROM s_3_end),
    s_3 AS (SELECT token, low, r1, r2, done, CASE
                WHEN e = '' OR done OR length(p) < r1 OR (e = 'ative' AND length(p) < r2) THEN w
                ELSE p || {_case(_STEP_3, "e")} END AS w FROM s_3_cut),
    s_4_end AS (SELECT *, regexp_extract(w, '({fours})\z') AS e FROM s_3),
    s_4_cut AS (SELECT *, substring(w, 1, length(w) - length(e)) AS p FROM s_4_end),
    s_4 AS (SELECT token, low, r1, r2, done, CASE
                WHEN e = '' OR done OR length(p) < r2 OR (e = 'ion' AND NOT regexp_matches(p, '[st]\z')) THEN w
                ELSE p END AS w FROM s_4_cut),
    s_5 AS (SELECT token, low, replace(CASE
                WHEN done THEN w
                WHEN w LIKE '%e' AND length(w) - 1 >= r2 THEN w[:-2]
                WHEN w LIKE '%e' AND length(w) - 1 >= r1 AND NOT regexp_matches(w[:-2], '{_SHORT}') THEN w[:-2]
                WHEN w LIKE '%ll' AND length(w) - 1 >= r2 THEN w[:-2]
                ELSE w END, 'Y', 'y') AS w FROM s_4),
    stems AS (SELECT token, CASE WHEN length(low) <= 2 THEN low ELSE coalesce({_case(_INVARIANT, "low")}, w) END AS stem
              FROM s_5)"""


def _token_rows(tokens: str, rows: str) -> str:
    """(row_id, pos, token) of a token list."""
    return f"""SELECT row_id, CAST(generate_subscripts(t, 1) - 1 AS INT) AS pos, unnest(t) AS token
    FROM (SELECT row_id, {tokens} AS t FROM ({rows}))"""


_SPLIT = "string_split(tweet, ' ')"
_KEPT = f"list_filter({_SPLIT}, lambda t: lower(t) NOT IN ({_STOP}))"


# Splits


def _hash(id: str) -> str:
    return f"md5('42:' || {id})"


_KFOLD = """classes AS (SELECT target, count(*) AS n, min(row_id) AS first FROM rows GROUP BY target),
    laid AS (SELECT target, n, coalesce(sum(n) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS start FROM classes),
    places AS (SELECT target, unnest(range(start::BIGINT, (start + n)::BIGINT)) % 5 AS fold FROM laid),
    dealt AS (SELECT target, fold, row_number() OVER (PARTITION BY target ORDER BY fold) AS r FROM places),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY row_id) AS r FROM rows),
    folded AS (SELECT numbered.*, CAST(dealt.fold AS INT) AS fold FROM numbered JOIN dealt USING (target, r))"""


# Metrics

_SCORES = f"""guesses AS ({_GUESSES}),
    names AS (SELECT DISTINCT target FROM guesses UNION SELECT DISTINCT predicted FROM guesses),
    tallies AS (SELECT names.target,
        CAST(count(*) FILTER (g.target = names.target) AS BIGINT) AS support,
        count(*) FILTER (g.predicted = names.target) AS given,
        count(*) FILTER (g.target = names.target AND g.predicted = names.target) AS hits
        FROM names JOIN guesses g ON g.target = names.target OR g.predicted = names.target GROUP BY names.target),
    ratios AS (SELECT target, support, CASE WHEN given = 0 THEN 0 ELSE hits / given END AS p,
               CASE WHEN support = 0 THEN 0 ELSE hits / support END AS r FROM tallies),
    scores AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM ratios)"""
_REPORT = f"""WITH {_SCORES},
    hit AS (SELECT avg(CASE WHEN target = predicted THEN 1.0::DOUBLE ELSE 0 END) AS a, count(*) AS n FROM guesses)
    SELECT target, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM scores
    UNION ALL SELECT 'accuracy', round(a, 6), round(a, 6), round(a, 6), n FROM hit
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT)
              FROM scores
    UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
              round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores"""


def _weighted(column: str, name: str) -> str:
    return f"WITH {_SCORES} SELECT round(sum({column} * support) / sum(support), 6) AS {name} FROM scores"


# Search

_RUNS = "(SELECT DISTINCT user_id AS run_id FROM events)"


def _draw(name: str) -> str:
    return f"CAST('0x' || substr(md5('42:{name}:' || run_id), 1, 8) AS BIGINT)"


def _int(name: str, low: int, high: int, alias: str | None = None) -> str:
    return f"CAST({_draw(name)} % {high - low} + {low} AS INT) AS {alias or name}"


def _uniform(name: str, low: float, high: float, alias: str | None = None) -> str:
    return f"round({low} + {_draw(name)} / 4294967296.0::DOUBLE * {high - low!r}::DOUBLE, 6) AS {alias or name}"


_REPORTS = """SELECT user_id AS run_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS step,
              max(value) AS metric FROM events GROUP BY ALL"""
_RESULTS = "SELECT user_id AS trial_id, max(value) AS accuracy, count(*) AS reports FROM events GROUP BY user_id"


# Scoring

_REQUESTS = f"""SELECT row_id, CASE row_id % 10
    WHEN 0 THEN '{{''data'': [''' || row_id || ''']}}'
    WHEN 1 THEN '{{"data": []}}'
    WHEN 2 THEN CAST(json_object('text', [tweet]) AS VARCHAR)
    WHEN 3 THEN '{{"data": [3, "three"]}}'
    WHEN 4 THEN CAST(json_object('data', [[tweet]]) AS VARCHAR)
    WHEN 5 THEN CAST(json_object('data', tweet) AS VARCHAR)
    WHEN 6 THEN CAST(json_object('data', [tweet, 'second']) AS VARCHAR)
    ELSE CAST(json_object('data', [tweet]) AS VARCHAR) END AS body FROM ({_MESSAGES})"""
_PARSED = f"""SELECT row_id, CASE
    WHEN NOT json_valid(body) THEN NULL
    WHEN json_type(body, '$.data[0]') = 'VARCHAR' THEN json_extract_string(body, '$.data[0]')
    WHEN json_type(body, '$.data') = 'VARCHAR' THEN nullif(substring(json_extract_string(body, '$.data'), 1, 1), '')
    END AS tweet FROM ({_REQUESTS})"""
_SHARES = """SELECT conv_id, role, count(*) / sum(count(*)) OVER (PARTITION BY conv_id) AS p
             FROM conversations GROUP BY conv_id, role"""
_RANKED = f"""SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY p DESC, role) AS INT) AS rank,
              role AS class, round_even(p, 2) AS probability FROM ({_SHARES})"""

_BEST_SPLITS = f"""WITH {_tf(_MESSAGES, 2, 3)},
    rows AS (SELECT row_id, CAST(row_id % 16 AS INT) AS node, CASE WHEN target = 'user' THEN 1 ELSE 0 END AS label
             FROM ({_MESSAGES}) WHERE tweet IS NOT NULL AND target IS NOT NULL),
    total AS (SELECT count(*) AS n FROM rows),
    vocabulary AS (SELECT gram, CAST(row_number() OVER (ORDER BY gram) - 1 AS INT) AS place, ln((1 + n) / (1.0 + df)::DOUBLE) + 1 AS idf
                   FROM (SELECT gram, count(*) AS df FROM tf GROUP BY gram), total),
    {_weights()},
    held AS (SELECT node, count(*) FILTER (label = 0) AS k0, count(*) FILTER (label = 1) AS k1 FROM rows GROUP BY node),
    entries AS (SELECT node, label, place, CAST(least(floor(0.5::DOUBLE - 16 * log2(tfidf)), 511) AS INT) AS bin
                FROM weights JOIN rows USING (row_id) JOIN vocabulary USING (gram)),
    steps AS (SELECT node, place, bin, count(*) FILTER (label = 0) AS c0, count(*) FILTER (label = 1) AS c1
              FROM entries GROUP BY node, place, bin),
    sides AS (SELECT *, CAST(sum(c0) OVER upto AS BIGINT) AS r0, CAST(sum(c1) OVER upto AS BIGINT) AS r1 FROM steps
              WINDOW upto AS (PARTITION BY node, place ORDER BY bin)),
    cut AS (SELECT node, place, bin, k0, k1, r0, r1, k0 - r0 AS l0, k1 - r1 AS l1 FROM sides JOIN held USING (node)),
    best AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY
                 (r0 * r0 + r1 * r1)::DOUBLE / (r0 + r1) + (l0 * l0 + l1 * l1)::DOUBLE / (l0 + l1) DESC, place, bin) AS rank
             FROM cut WHERE l0 + l1 > 0)
    SELECT node, place AS gram, bin, k0 + k1 AS node_n, k0 = 0 OR k1 = 0 AS pure, l0 + l1 AS left_n, r0 + r1 AS right_n,
        l0 = 0 OR l1 = 0 AS left_pure, r0 = 0 OR r1 = 0 AS right_pure FROM best WHERE rank = 1"""


def _suggested() -> str:
    space = "('min_class_frequency', true, 50, 100), ('n_estimators', true, 5, 120), ('min_df', true, 1, 10), "
    space += "('max_df', false, 0.4, 0.8), ('ngram_min', true, 2, 4), ('ngram_max', true, 4, 10)"
    part = lambda what: (
        f"('0x' || substr(md5('42:{what}:' || (1000000 + trial) || ':' || candidate || ':' || param), 1, 8))::BIGINT / 4294967296::DOUBLE"
    )
    one = lambda v: f"greatest(0::DOUBLE, 1 - abs(x - {v}) / w)"
    kernel = f"({one('value')} + {one('(2 * low - value)')} + {one('(2 * high - value)')}) / w"
    picked = ", ".join(
        f"max(CASE WHEN param = '{n}' THEN {v} END) AS {n}"
        for n, v in [(n, "CAST(floor(x) AS INT)") for n in ("min_class_frequency", "n_estimators", "min_df", "ngram_min", "ngram_max")]
        + [("max_df", "round(x, 6)")]
    )
    return f"""WITH drawn AS (SELECT run_id, {_int("min_class_frequency", 50, 100)}, {_int("n_estimators", 5, 120)},
        {_int("min_df", 1, 10)}, {_uniform("max_df", 0.4, 0.8)}, {_int("ngram_min", 2, 4)}, {_int("ngram_max", 4, 10)} FROM {_RUNS}),
    reached AS (SELECT user_id AS run_id, max(value) AS metric FROM events GROUP BY user_id),
    history AS (SELECT *, row_number() OVER (ORDER BY metric DESC, run_id)
                    <= least(25, ceil(0.25::DOUBLE * count(*) OVER ())) AS good
                FROM drawn JOIN reached USING (run_id) WHERE metric IS NOT NULL AND NOT isnan(metric)),
    seen AS (SELECT good, param, value FROM (SELECT good, min_class_frequency + 0.5::DOUBLE AS min_class_frequency,
        n_estimators + 0.5::DOUBLE AS n_estimators, min_df + 0.5::DOUBLE AS min_df, max_df::DOUBLE AS max_df,
        ngram_min + 0.5::DOUBLE AS ngram_min, ngram_max + 0.5::DOUBLE AS ngram_max FROM history)
        UNPIVOT (value FOR param IN (min_class_frequency, n_estimators, min_df, max_df, ngram_min, ngram_max))),
    space(param, whole, low, high) AS (SELECT param, whole, low::DOUBLE, high::DOUBLE FROM (VALUES {space}) v(param, whole, low, high)),
    counted AS (SELECT param, whole, low, high, count(*) FILTER (good) AS n_good, count(*) FILTER (NOT good) AS n_other,
        list_sort(list(value) FILTER (good)) AS goods FROM space JOIN seen USING (param) GROUP BY ALL),
    asked AS (SELECT *, (high - low) / least(1.0::DOUBLE + n_good, 100) AS w_good, (high - low) / least(1.0::DOUBLE + n_other, 100) AS w_other
        FROM counted, range(18) t(trial), range(24) c(candidate)),
    placed AS (SELECT *, CAST(floor({part("value")} * (n_good + 1)) AS INT) AS pick, {part("left")} AS u, {part("right")} AS v FROM asked),
    tried AS (SELECT *, CASE WHEN pick > 0 THEN goods[pick] + w_good * (u + v - 1) ELSE low + u * (high - low) END AS z FROM placed),
    moved AS (SELECT *, least(CASE WHEN z < low THEN 2 * low - z WHEN z > high THEN 2 * high - z ELSE z END,
        high - CASE WHEN whole THEN 0.5::DOUBLE ELSE 0 END) AS y FROM tried),
    candidates AS (SELECT *, CASE WHEN whole THEN floor(y) + 0.5::DOUBLE ELSE y END AS x FROM moved),
    dense AS (SELECT trial, param, candidate, x, low, high, n_good, n_other,
        coalesce(sum({kernel.replace("/ w", "/ w_good")}) FILTER (good), 0) AS l,
        coalesce(sum({kernel.replace("/ w", "/ w_other")}) FILTER (NOT good), 0) AS g
        FROM candidates JOIN seen USING (param) GROUP BY ALL),
    rated AS (SELECT *, round(((l + 1 / (high - low)) / (n_good + 1)) / ((g + 1 / (high - low)) / (n_other + 1)), 9) AS ratio FROM dense),
    best AS (SELECT *, row_number() OVER (PARTITION BY trial, param ORDER BY ratio DESC, candidate) AS rank FROM rated)
    SELECT 1000000 + trial AS run_id, {picked} FROM best WHERE rank = 1 GROUP BY trial"""


ORACLE_SQL = {
    "best_splits": _BEST_SPLITS,
    "suggest_trials": _suggested(),
    "read_labelled_csv": "SELECT text AS tweet, lang AS target FROM documents",
    "read_labelled_csv_cut": "SELECT text AS tweet, lang AS target FROM documents",
    "write_prepared": f"SELECT * FROM ({_JUDGED}) WHERE tweet IS NOT NULL AND target IS NOT NULL",
    "register_dataset": f"SELECT *, 2::INT AS version FROM ({_SOURCES})",
    "read_dataset_version": f"SELECT *, 1::INT AS version FROM ({_DOCS})",
    "log_metrics": """SELECT 'lang' AS run_id, 0::BIGINT AS step, lang AS name, count(*)::DOUBLE AS value
        FROM documents GROUP BY lang
        UNION ALL SELECT 'source', 1, source, count(*)::DOUBLE FROM documents GROUP BY source""",
    "write_report": _REPORT,
    "select_labelled": _SOURCES,
    "drop_nulls": f"SELECT * FROM ({_JUDGED}) WHERE tweet IS NOT NULL AND target IS NOT NULL",
    "filter_min_class_frequency": f"""SELECT * FROM ({_MESSAGES}) QUALIFY count(*) OVER (PARTITION BY target) >= 50""",
    "filter_min_class_frequency_sources": f"""SELECT row_id, target FROM ({_JUDGED}) WHERE target IS NOT NULL
        QUALIFY count(*) OVER (PARTITION BY target) >= 150""",
    "filter_known_labels": """SELECT doc_id AS row_id, text AS tweet, source AS target FROM documents WHERE source IN
        (SELECT source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1))""",
    "exclude_rows": f"SELECT * FROM ({_DOCS}) WHERE row_id NOT IN (SELECT doc_id FROM labels)",
    "class_counts": "SELECT lang AS target, count(*) AS n FROM documents GROUP BY lang",
    "class_counts_lineitem": "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag",
    "n_classes": "SELECT count(DISTINCT source) AS n_classes FROM documents",
    "distinct_labels": "SELECT DISTINCT role AS target FROM conversations",
    "mean_over_folds": f"""WITH rows AS ({_GUESSES}), {_KFOLD}, per_fold AS (SELECT fold,
        avg(CASE WHEN target = predicted THEN 1.0::DOUBLE ELSE 0 END) AS a FROM folded GROUP BY fold)
        SELECT round(avg(a), 6) AS accuracy FROM per_fold""",
    "tokenize_space": _token_rows(_SPLIT, _DOCS),
    "remove_stopwords": _token_rows(_KEPT, _DOCS),
    "stem_tokens": f"""WITH tokens AS ({_token_rows(_SPLIT, _DOCS)}), {_stems("tokens")}
        SELECT row_id, pos, stem AS token FROM tokens JOIN stems USING (token)""",
    "join_tokens": "SELECT doc_id AS row_id, replace(text, chr(10), ' ') AS joined FROM documents",
    "strip_quotes": """SELECT doc_id AS row_id, replace(text, '"', '') AS bare FROM documents""",
    "char_wb_ngrams": f"""WITH listed AS (SELECT row_id, flatten(list_transform({_words("tweet")},
            lambda w: {_gram_lists(3, 7, "' ' || w || ' '")})) AS g FROM ({_MESSAGES}))
        SELECT row_id, CAST(generate_subscripts(g, 1) - 1 AS INT) AS pos, unnest(g) AS gram FROM listed""",
    "prepare_text": f"""WITH rows AS (SELECT * FROM ({_JUDGED}) WHERE tweet IS NOT NULL AND target IS NOT NULL),
        tokens AS ({_token_rows(_KEPT, "SELECT row_id, tweet FROM rows")}), {_stems("tokens")},
        joined AS (SELECT row_id, string_agg(stem, ' ' ORDER BY pos) AS t FROM tokens JOIN stems USING (token)
                   GROUP BY row_id)
        SELECT row_id, coalesce(replace(t, '"', ''), '') AS tweet, target FROM rows LEFT JOIN joined USING (row_id)""",
    "term_frequency": f"WITH {_tf(_MESSAGES, 3, 7)} SELECT * FROM tf",
    "document_frequency_of_text": f"WITH {_tf(_DOCS, 3, 4)} SELECT gram, count(*) AS df FROM tf GROUP BY gram",
    "document_frequency": f"WITH {_tf(_DOCS, 3, 4)} SELECT gram, count(*) AS df FROM tf GROUP BY gram",
    "prune_vocabulary": f"WITH {_vocabulary(_DOCS, 3, 4)} SELECT gram, df FROM vocabulary",
    "inverse_document_frequency": f"""WITH {_vocabulary(_DOCS, 3, 4)}
        SELECT gram, df, round(ln((1 + n) / (1.0 + df)::DOUBLE) + 1, 6) AS idf FROM frequency, total""",
    "fold_vocabularies": f"""WITH rows AS ({_MESSAGES}), {_KFOLD}, {_tf(_MESSAGES, 3, 7)},
        outside AS (SELECT f.fold, count(*) AS n FROM range(5) f(fold) JOIN folded ON folded.fold <> f.fold
                    WHERE tweet IS NOT NULL GROUP BY f.fold),
        counted AS (SELECT f.fold, gram, count(*) AS df FROM tf JOIN folded USING (row_id)
                    JOIN range(5) f(fold) ON folded.fold <> f.fold GROUP BY f.fold, gram)
        SELECT CAST(fold AS INT) AS fold, gram, df, n, round(ln((1 + n) / (1.0 + df)::DOUBLE) + 1, 6) AS idf
        FROM counted JOIN outside USING (fold) WHERE df >= 5 AND df <= 0.6::DOUBLE * n""",
    "tfidf": _tfidf(_DOCS, 3, 4),
    "tfidf_range_a": _tfidf(_MESSAGES, 3, 7),
    "tfidf_range_b": _tfidf(_MESSAGES, 4, 7),
    "tfidf_transform": f"""WITH {_vocabulary(_DOCS, 3, 4)}, {_tf(_MESSAGES, 3, 4, "other")}, {_weights("other")}
        SELECT row_id, gram, round(tfidf, 6) AS tfidf FROM weights""",
    "text_features": f"""WITH {_vocabulary(_MESSAGES, 3, 7)}, {_weights()}, sums AS
        (SELECT row_id, count(*) AS n, sum(tfidf) AS t FROM weights GROUP BY row_id)
        SELECT row_id, coalesce(n, 0) AS n, round(coalesce(t, 0), 4) AS total FROM ({_MESSAGES}) LEFT JOIN sums USING (row_id)""",
    "stratified_split": f"""SELECT row_id, target, CASE WHEN row_number() OVER (PARTITION BY target
            ORDER BY {_hash("row_id")}, row_id) <= round_even(0.8::DOUBLE * count(*) OVER (PARTITION BY target), 0)
            THEN 'train' ELSE 'test' END AS split FROM ({_DOCS})""",
    "shuffled_split": f"""SELECT row_id, CASE WHEN row_number() OVER (ORDER BY {_hash("row_id")}, row_id)
            <= ceil(0.2::DOUBLE * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM ({_DOCS})""",
    "shuffled_split_lineitem": f"""SELECT row_id, CASE WHEN row_number() OVER (ORDER BY {_hash("row_id")}, row_id)
            <= ceil(0.2::DOUBLE * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
        FROM (SELECT l_orderkey * 10 + l_linenumber AS row_id FROM lineitem)""",
    "stratified_kfold": f"WITH rows AS ({_DOCS}), {_KFOLD} SELECT row_id, target, fold FROM folded",
    "accuracy": f"""SELECT round(avg(CASE WHEN target = predicted THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy
        FROM ({_GUESSES})""",
    "weighted_precision": _weighted("p", "weighted_precision"),
    "weighted_recall": _weighted("r", "weighted_recall"),
    "weighted_f1": _weighted("f", "weighted_f1"),
    "classification_report": _REPORT,
    "sample_trials_a": f"""SELECT run_id, {_int("min_class_frequency", 50, 100)}, {_int("n_estimators", 5, 120)},
        {_int("min_df", 1, 10)}, {_uniform("max_df", 0.4, 0.8)}, {_int("ngram_min", 2, 4)}, {_int("ngram_max", 4, 10)}
        FROM {_RUNS}""",
    "sample_trials_b": f"""SELECT run_id, {_int("min_doc_freq", 2, 10, "min_df")},
        {_uniform("max_doc_freq", 0.4, 0.7, "max_df")}, {_int("n_estimators", 1, 1000)},
        {_int("min_class_frequency", 1, 50)} FROM {_RUNS}""",
    "bandit_keep": f"""SELECT *, metric >= best - 0.05::DOUBLE AS keep FROM (SELECT run_id, step, metric,
        max(metric) OVER (PARTITION BY step) AS best FROM ({_REPORTS}) WHERE step % 3 = 0)""",
    "surviving_runs": f"""SELECT run_id FROM (SELECT run_id, step % 20 = 0 AS due, metric,
        max(metric) OVER (PARTITION BY step) AS best FROM ({_REPORTS}))
        GROUP BY run_id HAVING count(*) FILTER (due AND metric < best - 200.0::DOUBLE) = 0""",
    "best_trial": f"SELECT * FROM ({_RESULTS}) ORDER BY accuracy DESC, trial_id LIMIT 1",
    "trial_metrics": f"""SELECT 'trial-' || trial_id AS run_id, 0::BIGINT AS step, 'Accuracy' AS name,
        accuracy AS value FROM ({_RESULTS})""",
    "register_model": """SELECT 'docs' AS name, CAST(row_number() OVER (ORDER BY lang) AS INT) AS version,
        'models/' || lang AS path, 'target' AS label, CAST(count(*) AS VARCHAR) AS accuracy FROM documents GROUP BY lang""",
    "latest_model": """SELECT event_type AS name, CAST(event_id AS INT) AS version, 'models/' || event_id AS path
        FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) = 1""",
    "parse_requests": _PARSED,
    "encode_response": f"""SELECT conv_id, '{{' || string_agg('"' || role || '":' || CAST(round(p, 2) AS VARCHAR), ','
        ORDER BY role) || '}}' AS response FROM ({_SHARES}) GROUP BY conv_id""",
    "error_to_empty": f"""SELECT row_id, CASE WHEN tweet IS NULL THEN '{{}}' WHEN length(tweet) > 200
        THEN '{{"long":1.0,"short":0.0}}' ELSE '{{"long":0.0,"short":1.0}}' END AS response FROM ({_PARSED})""",
    "rank_scores": _RANKED,
    "rank_scores_top": f"SELECT * FROM ({_RANKED}) WHERE rank = 1",
    "decode_split": f"SELECT row_id, 0::BIGINT AS index, tweet FROM ({_MESSAGES})",
    "encode_records": f"""SELECT row_id, '[{{"tweet":' || CAST(to_json(tweet) AS VARCHAR) || '}}]' AS body
        FROM ({_MESSAGES})""",
}
