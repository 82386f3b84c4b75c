"""The same results as plain SQL over the given tables, for an independent engine."""

from lexigauge.catalog.setup import FIXED_INTERCEPT, GROUPS, LEXICONS, STOP
from lexigauge.config import MAX_FEATURES, SEED, SIGNAL_LABELS, SIGNALS
from lexigauge.operators.profile import COMPARED, REFERENCED
from lexigauge.plans.report import EDGE_TEXTS

_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]+"
# fixed value: what counts as a URL
_URL = (
    r"https?://\S+|\b(?:www\.)?[a-z0-9-]+(?:\.[a-z0-9-]+)*\.(?:com|net|org|io|co|info|biz|us|uk|ru|xyz)\b(?:/\S*)?"
)


def _clean(text: str) -> str:
    return f"trim(regexp_replace({text}, '{_SPACE}', ' ', 'g'), ' ')"


def _low(text: str) -> str:
    return rf"regexp_replace(lower({text}), '\S+@\S+', ' ', 'g')"


def _urls(low: str) -> str:
    return f"len(regexp_extract_all({low}, '{_URL}'))"


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _hits(low: str, terms) -> str:
    return f"list_filter([{_quoted(terms)}], lambda t: regexp_matches({low}, '(^|[^a-z0-9])' || regexp_escape(t)))"


_GROUPS = ", ".join(f"('{o}', {y}, '{g}', {n}, '{name}')" for o, y, g, n, name in GROUPS)
_LABELLED = f"""
groups(origin, y, grp, grp_order, grp_name) AS (VALUES {_GROUPS}),
corpus AS (
    SELECT doc_id, raw, origin, y, grp, grp_order, grp_name, {_clean('raw')} AS text
    FROM (
        SELECT d.doc_id, d.text AS raw, CASE WHEN d.lang = 'en' THEN 'en' ELSE 'other' END AS origin, l.toxic AS y
        FROM documents d JOIN labels l USING (doc_id)
    ) JOIN groups USING (origin, y)
),
docs AS (
    SELECT *, {_low('text')} AS low
    FROM corpus
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY grp_order, doc_id) = 1
)"""
_ALL = f"""
docs AS (SELECT *, {_low('text')} AS low FROM (SELECT doc_id, {_clean('text')} AS text FROM documents))"""

_DISTINCT = f"""{_ALL.rstrip(')')}) QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1)"""


def _signals(source: str, keep: str) -> str:
    return f"""
counted AS (
    SELECT {keep}, text, low,
        CASE WHEN text = '' THEN 0 ELSE len(string_split(text, ' ')) END AS words,
        len(string_split(text, ' ')) AS split_words,
        length(text) AS chars,
        length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters,
        length(regexp_replace(text, '[^A-Z]', '', 'g')) AS caps,
        length(regexp_replace(text, '[^!]', '', 'g')) AS excl,
        length(regexp_replace(text, '[^!?]', '', 'g')) AS punct,
        {_urls('low')} AS urls,
        {_hits('low', LEXICONS['urgency'])} AS urgency_hits,
        {_hits('low', LEXICONS['cta'])} AS cta_hits
    FROM {source}
),
signals AS (
    SELECT *,
        ln(1 + words) AS log_words, ln(1 + urls) AS log_urls,
        len(urgency_hits)::DOUBLE AS urgency_terms, len(cta_hits)::DOUBLE AS cta_terms,
        CASE WHEN letters > 0 THEN caps / letters ELSE 0.0 END AS caps_ratio,
        100.0 * punct / greatest(words, 1) AS punct_per_100w
    FROM counted
)"""


def _terms(source: str, keep: str, out: str = "terms") -> str:
    return f"""
{out} AS (
    SELECT {keep}, term, count(*) AS cnt
    FROM (
        SELECT {keep}, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term
        FROM (SELECT {keep}, regexp_extract_all(low, '[a-z0-9][a-z0-9]+') AS w FROM {source})
    )
    GROUP BY ALL
)"""


def _vocabulary(n: int, key: str = "doc_id") -> str:
    return f"""
vocabulary AS (
    SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, tf, df
    FROM (
        SELECT term, sum(cnt)::BIGINT AS tf, count(DISTINCT {key}) AS df FROM terms
        GROUP BY term HAVING count(DISTINCT {key}) >= 2 ORDER BY tf DESC, term LIMIT {n}
    )
)"""


_IDF = "ln((1 + (SELECT count(*) FROM docs)) / (1 + df)) + 1"

_PROFILE = """
profile AS (
    SELECT grp, count(*) AS docs, median(split_words) AS median_words, avg(urls) AS urls,
        100 * avg((urls > 0)::INT) AS url_any, 100 * avg((len(urgency_hits) > 0)::INT) AS urg_any,
        100 * avg((len(cta_hits) > 0)::INT) AS cta_any, 100 * avg(caps_ratio) AS caps, avg(excl) AS excl
    FROM signals GROUP BY grp
)"""
_PROFILE_ROWS = """SELECT grp, docs, median_words, round(urls, 6) AS urls, round(url_any, 6) AS url_any,
    round(urg_any, 6) AS urg_any, round(cta_any, 6) AS cta_any, round(caps, 6) AS caps, round(excl, 6) AS excl
FROM profile"""

_LABELLED_SIGNALS = f"{_LABELLED}, {_signals('docs', 'doc_id, grp, y, origin')}"
_RATE_LIST = ["any", *LEXICONS["urgency"]]
_RATES = f"""
rates AS (
    SELECT grp, term, 100 * avg((CASE WHEN term = 'any' THEN len(urgency_hits) > 0 ELSE list_contains(urgency_hits, term) END)::INT) AS pct
    FROM signals CROSS JOIN (SELECT unnest([{_quoted(_RATE_LIST)}]) AS term)
    GROUP BY grp, term
)"""
_WORDS = f"""
words AS (
    SELECT grp, rank, word, docs, 100.0 * docs / n AS pct
    FROM (
        SELECT grp, word, count(*) AS docs, row_number() OVER (PARTITION BY grp ORDER BY count(*) DESC, word) AS rank
        FROM (SELECT grp, unnest(list_distinct(regexp_extract_all(low, '[a-z][a-z][a-z]+'))) AS word FROM docs)
        WHERE word NOT IN ({_quoted(STOP)})
        GROUP BY grp, word
    ) JOIN (SELECT grp, count(*) AS n FROM docs GROUP BY grp) USING (grp)
    WHERE rank <= 10
)"""

_FOLDS = f"""
shuffled AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY md5('{SEED}:' || sha256(text))) AS rank FROM docs
)"""

# The model with coefficients by position, applied to every document.
_EVERY = f"SELECT doc_id, {_clean('text')} AS text FROM documents"
_EVERY_AND_BLANK = f"{_EVERY} UNION ALL SELECT -1, ''"
_ENTRY_SIGNALS = ", ".join(f"('{n}', {i})" for i, n in enumerate(SIGNALS))
_FIXED = f"""
WITH {_LABELLED}, {_signals('docs', 'doc_id')}, {_terms('docs', 'doc_id')}, {_vocabulary(MAX_FEATURES)},
model_terms AS (SELECT term, idx, {_IDF} AS idf, (idx % 7 - 3) * 0.5 AS coef FROM vocabulary),
scale AS (
    {' UNION ALL '.join(
        f"SELECT '{n}' AS name, ({i} - 2) * 0.2 AS coef, avg({n}) AS mean, "
        f"CASE WHEN stddev_pop({n}) = 0 THEN 1 ELSE stddev_pop({n}) END AS std FROM signals"
        for i, n in enumerate(SIGNALS)
    )}
),
every AS (SELECT *, {_low('text')} AS low FROM ({_EVERY})),
{_signals('every', 'doc_id').replace('counted AS', 'every_counted AS').replace('signals AS', 'every_signals AS').replace('FROM counted', 'FROM every_counted')},
{_terms('every', 'doc_id', 'every_terms')},
weighted AS (
    SELECT doc_id, term, (1 + ln(cnt)) * idf AS w, coef FROM every_terms JOIN model_terms USING (term)
),
norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm, count(*) AS known FROM weighted GROUP BY doc_id),
contributions AS (
    SELECT doc_id, term, w / norm * coef AS value FROM weighted JOIN norms USING (doc_id)
    UNION ALL
    SELECT doc_id, '[' || name || ']', (x - mean) / std * coef
    FROM (UNPIVOT (SELECT doc_id, {', '.join(SIGNALS)} FROM every_signals) ON {', '.join(SIGNALS)} INTO NAME name VALUE x)
    JOIN scale USING (name)
),
scored AS (
    SELECT doc_id, coalesce(known, 0) AS known_terms, z, 1 / (1 + exp(-z)) AS p,
        CASE WHEN 1 / (1 + exp(-z)) >= 0.5 THEN 1 ELSE 0 END AS pred
    FROM (SELECT doc_id, sum(value) + {FIXED_INTERCEPT} AS z FROM contributions GROUP BY doc_id)
    LEFT JOIN norms USING (doc_id)
)"""
_SCORED = f"{_FIXED} SELECT doc_id, known_terms, round(z, 6) AS z, round(p, 6) AS p, pred FROM scored"

_RANKED = """
ranked AS (
    SELECT doc_id, term, value, row_number() OVER (PARTITION BY doc_id ORDER BY abs(value) DESC, term) AS rank FROM contributions
)"""
_TYPICAL = (("urgency", "urg_any"), ("cta", "cta_any"), ("urls", "urls"), ("length", "median_words"), ("caps", "caps"))


def _trials(parted: str, trains: str, tests: str) -> str:
    """`outcomes` (model, grp, y, n, correct, positive) of trials with coefficients by position.

    `parted`: a query for (doc_id, grp, y, text, low, part); `trains`, `tests`: queries for (model, part).
    """
    signal_rows = f"(UNPIVOT (SELECT doc_id, part, {', '.join(SIGNALS)} FROM signals) ON {', '.join(SIGNALS)} INTO NAME name VALUE x)"
    places = ", ".join(f"('{n}', {i})" for i, n in enumerate(SIGNALS))
    return f"""
parted AS ({parted}), trains AS ({trains}), tests AS ({tests}),
{_signals('parted', 'doc_id, grp, y, part')}, {_terms('parted', 'doc_id, part')},
sizes AS (SELECT model, count(*) AS n FROM parted JOIN trains USING (part) GROUP BY model),
stats AS (SELECT model, term, sum(cnt) AS tf, count(*) AS df FROM terms JOIN trains USING (part) GROUP BY model, term HAVING count(*) >= 2),
kept AS (SELECT * FROM stats QUALIFY row_number() OVER (PARTITION BY model ORDER BY tf DESC, term) <= {MAX_FEATURES}),
model_terms AS (
    SELECT model, term, ln((1 + n) / (1 + df)) + 1 AS idf, ((row_number() OVER (PARTITION BY model ORDER BY term) - 1) % 7 - 3) * 0.5 AS coef
    FROM kept JOIN sizes USING (model)
),
places(name, pos) AS (VALUES {places}),
scale AS (
    SELECT model, name, (pos - 2) * 0.2 AS coef, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1 ELSE stddev_pop(x) END AS std
    FROM {signal_rows} JOIN trains USING (part) JOIN places USING (name) GROUP BY model, name, pos
),
weighted AS (SELECT model, doc_id, (1 + ln(cnt)) * idf AS w, coef FROM terms JOIN tests USING (part) JOIN model_terms USING (model, term)),
from_terms AS (SELECT model, doc_id, sum(w * coef) / sqrt(sum(w * w)) AS z FROM weighted GROUP BY model, doc_id),
from_signals AS (
    SELECT model, doc_id, sum((x - mean) / std * coef) AS z FROM {signal_rows} JOIN tests USING (part) JOIN scale USING (model, name) GROUP BY model, doc_id
),
judged AS (
    SELECT model, grp, y, CASE WHEN 1 / (1 + exp(-(s.z + coalesce(t.z, 0) + {FIXED_INTERCEPT}))) >= 0.5 THEN 1 ELSE 0 END AS pred
    FROM from_signals s LEFT JOIN from_terms t USING (model, doc_id) JOIN parted USING (doc_id)
),
outcomes AS (
    SELECT model, grp, y, count(*) AS n, sum((pred = y)::INT) AS correct, sum(pred) AS positive FROM judged GROUP BY model, grp, y
)"""


_FOLDED = "SELECT doc_id, grp, y, text, low, (rank - 1) % 5 AS part FROM shuffled"
_OTHER_FOLDS = "SELECT m.range AS model, p.range AS part FROM range(5) m, range(5) p WHERE m.range {} p.range"
_SPLIT = """
split_sizes AS (SELECT grp, count(*) AS n, ceil(0.2 * (SELECT count(*) FROM docs)) AS wanted, (SELECT count(*) FROM docs) AS total FROM docs GROUP BY grp),
quotas AS (
    SELECT grp, floor(wanted * n / total)
        + CASE WHEN row_number() OVER (ORDER BY round(wanted * n / total - floor(wanted * n / total), 9) DESC, grp)
            <= wanted - sum(floor(wanted * n / total)) OVER () THEN 1 ELSE 0 END AS quota
    FROM split_sizes
),
split AS (SELECT *, CASE WHEN rank <= quota THEN 'test' ELSE 'train' END AS part FROM shuffled JOIN quotas USING (grp))"""

_LISTED_METRICS = ("median_words", "urls", "url_any", "urg_any", "cta_any", "caps", "excl")
_DIGITS = {"urls": 2, "url_any": 1, "urg_any": 1, "cta_any": 1, "caps": 1, "excl": 2}


def _published(metric: str) -> str:
    return f"round_even({metric}, {_DIGITS[metric]})" if metric in _DIGITS else metric


ORACLES = {
    "group_profile": f"WITH {_LABELLED_SIGNALS}, {_PROFILE} {_PROFILE_ROWS}",
    "role_profile": f"""WITH docs AS (
        SELECT grp, text, {_low('text')} AS low FROM (SELECT role AS grp, {_clean('text')} AS text FROM conversations)
    ), {_signals('docs', 'grp')}, {_PROFILE} {_PROFILE_ROWS}""",
    "group_counts": f"""WITH {_LABELLED}
        SELECT grp, grp_name, count(*) AS n_rows, (SELECT count(*) FROM docs d WHERE d.grp = c.grp) AS n_distinct
        FROM corpus c GROUP BY grp, grp_name""",
    "clean_text": f"WITH {_ALL} SELECT doc_id, text, low FROM docs",
    "dedup_keep_first": f"""
        SELECT doc_id, origin, sha256(text) AS text_hash
        FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN 'en' ELSE 'other' END AS origin, {_clean('text')} AS text FROM documents)
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY origin, doc_id) = 1""",
    "label_conflicts": f"""WITH cleaned AS (SELECT doc_id, source, sha256({_clean('text')}) AS text_hash FROM documents),
        labelled AS (SELECT * FROM cleaned JOIN labels USING (doc_id))
        {' UNION ALL '.join(
            f"SELECT '{c}' AS label, text_hash, min({c})::VARCHAR AS lowest, max({c})::VARCHAR AS highest FROM {t} "
            f"GROUP BY text_hash HAVING count(DISTINCT {c}) > 1"
            for c, t in (('toxic', 'labelled'), ('quality', 'labelled'), ('source', 'cleaned')))}""",
    "duplicate_audit": f"""
        SELECT lang, count(*) AS n_rows, count(*) - count(DISTINCT (text, lang, source, n_chars)) AS identical_rows,
            count(*) - count(DISTINCT text) AS identical_text, count(DISTINCT text) AS unique_text,
            count(DISTINCT {_clean('text')}) AS after_cleaning
        FROM documents GROUP BY lang""",
    "conversation_audit": f"""
        SELECT role, count(*) AS n_rows, count(*) - count(DISTINCT (role, text)) AS identical_rows,
            count(*) - count(DISTINCT text) AS identical_text, count(DISTINCT text) AS unique_text,
            count(DISTINCT {_clean('text')}) AS after_cleaning
        FROM conversations GROUP BY role""",
    "token_counts": f"WITH {_DISTINCT}, {_terms('docs', 'doc_id')} SELECT doc_id, term, cnt FROM terms",
    "vocabulary": f"WITH {_DISTINCT}, {_terms('docs', 'doc_id')}, {_vocabulary(MAX_FEATURES)} SELECT * FROM vocabulary",
    "conversation_vocabulary": f"""WITH docs AS (
        SELECT id, {_low('text')} AS low
        FROM (SELECT row_number() OVER () AS id, {_clean('text')} AS text FROM conversations)
    ), {_terms('docs', 'id')}, {_vocabulary(MAX_FEATURES, 'id')} SELECT * FROM vocabulary""",
    "idf_weights": f"""WITH {_DISTINCT}, {_terms('docs', 'doc_id')}, {_vocabulary(MAX_FEATURES)}
        SELECT term, df, round({_IDF}, 6) AS idf FROM vocabulary""",
    "tfidf_l2": f"""WITH {_DISTINCT}, {_terms('docs', 'doc_id')}, {_vocabulary(MAX_FEATURES)},
        weighted AS (SELECT doc_id, term, (1 + ln(cnt)) * ({_IDF}) AS w FROM terms JOIN vocabulary USING (term))
        SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM weighted""",
    "signals": f"""WITH {_ALL}, {_signals('docs', 'doc_id')}
        SELECT doc_id, words, chars, letters, caps, punct, excl, urls,
            array_to_string(urgency_hits, ',') AS urgency_hits, array_to_string(cta_hits, ',') AS cta_hits,
            round(100 * caps_ratio, 6) AS caps_pct, {', '.join(f'round({s}, 6) AS {s}' for s in SIGNALS)}
        FROM signals""",
    "signal_scaler": f"""WITH {_DISTINCT}, {_signals('docs', 'doc_id')} {' UNION ALL '.join(
        f"SELECT {i} AS pos, '{s}' AS name, round(avg({s}), 6) AS mean, "
        f"round(CASE WHEN stddev_pop({s}) = 0 THEN 1 ELSE stddev_pop({s}) END, 6) AS std FROM signals"
        for i, s in enumerate(SIGNALS))}""",
    "url_stats": f"""
        SELECT page_id, {_urls('body')} AS n_urls, regexp_matches(body, '{_URL}') AS has_url, {_urls('own')} AS n_own
        FROM (SELECT page_id, {_low(_clean('html'))} AS body, {_low(_clean('url'))} AS own FROM pages)""",
    "lexicon_rates": f"WITH {_LABELLED_SIGNALS}, {_RATES} SELECT grp, term, round(pct, 6) AS pct FROM rates",
    "lexicon_hits": f"""WITH {_ALL}
        SELECT doc_id, kind, term FROM docs, (VALUES {', '.join(f"('{k}', '{t}')" for k, ts in LEXICONS.items() for t in ts)}) AS x(kind, term)
        WHERE regexp_matches(low, '(^|[^a-z0-9])' || regexp_escape(term))""",
    "top_words": f"WITH {_LABELLED}, {_WORDS} SELECT grp, rank, word, docs, round(pct, 6) AS pct FROM words",
    "rollup_counts": f"""WITH {_LABELLED}
        SELECT coalesce(origin, 'all') AS origin, coalesce(y::VARCHAR, 'all') AS y, grouping(origin, y)::INT AS level, count(*) AS n_rows, count(DISTINCT text) AS distinct_texts
        FROM corpus GROUP BY GROUPING SETS ((origin, y), (origin), (y), ())""",
    "class_reference": f"""WITH {_LABELLED_SIGNALS}, {_PROFILE}
        SELECT y, {', '.join(f'round(avg({m}), 6) AS {m}' for m in REFERENCED)}
        FROM profile JOIN groups USING (grp) GROUP BY y""",
    "comparison": f"""WITH {_LABELLED_SIGNALS}, {_PROFILE},
        long AS ({' UNION ALL '.join(
            f"SELECT '{m}' AS metric, grp, {m}::DOUBLE AS value FROM profile JOIN groups USING (grp) WHERE origin = 'en'"
            for m in COMPARED)})
        SELECT metric, grp, round(value, 6) AS value,
            round(CASE WHEN max(value) OVER w > 0 THEN value / (1.1 * max(value) OVER w) ELSE 0 END, 6) AS rel_weight
        FROM long WINDOW w AS (PARTITION BY metric)""",
    "strat_folds": f"WITH {_LABELLED}, {_FOLDS} SELECT doc_id, grp, ((rank - 1) % 5)::INT AS fold FROM shuffled",
    "strat_split": f"""WITH {_LABELLED}, {_FOLDS},
        sizes AS (SELECT grp, count(*) AS n, ceil(0.2 * (SELECT count(*) FROM docs)) AS wanted, (SELECT count(*) FROM docs) AS total FROM docs GROUP BY grp),
        quotas AS (
            SELECT grp, floor(wanted * n / total)
                + CASE WHEN row_number() OVER (ORDER BY round(wanted * n / total - floor(wanted * n / total), 9) DESC, grp)
                    <= wanted - sum(floor(wanted * n / total)) OVER () THEN 1 ELSE 0 END AS quota
            FROM sizes
        )
        SELECT doc_id, grp, CASE WHEN rank <= quota THEN 'test' ELSE 'train' END AS split
        FROM shuffled JOIN quotas USING (grp)""",
    "first_rows": f"WITH {_LABELLED} SELECT grp, doc_id FROM docs QUALIFY row_number() OVER (PARTITION BY grp ORDER BY doc_id) <= 2",
    "fold_vocabulary": f"""WITH {_LABELLED}, {_FOLDS},
        folded AS (SELECT doc_id, low, (rank - 1) % 5 AS fold FROM shuffled),
        {_terms('folded', 'doc_id, fold')},
        trials AS (SELECT unnest(range(5)) AS model),
        stats AS (
            SELECT model, term, sum(cnt)::BIGINT AS tf, count(*) AS df
            FROM terms JOIN trials ON fold <> model GROUP BY model, term HAVING count(*) >= 2
        ),
        kept AS (SELECT * FROM stats QUALIFY row_number() OVER (PARTITION BY model ORDER BY tf DESC, term) <= {MAX_FEATURES})
        SELECT model::INT AS model, term, (row_number() OVER (PARTITION BY model ORDER BY term) - 1)::INT AS idx, tf, df,
            round(ln((1 + (SELECT count(*) FROM folded f WHERE f.fold <> kept.model)) / (1 + df)) + 1, 6) AS idf
        FROM kept""",
    "score_fixed": _SCORED,
    "stream_score": _SCORED,
    "stream_first_texts": f"""WITH lines AS (
            SELECT event_id, ts, epoch_us(ts) // 86400000000 AS day, sha256({_clean("event_type || ' ' || props")}) AS text_hash FROM events
        )
        SELECT day, text_hash, arg_min(event_id, (ts, event_id)) AS event_id, count(*) AS copies FROM lines
        WHERE (day + 1) * 86400000000 <= (SELECT epoch_us(max(ts)) - 7200000000 FROM lines) GROUP BY day, text_hash""",
    "stream_distinct_texts": f"""
        SELECT text_hash, 1::BIGINT AS n FROM (SELECT DISTINCT sha256({_clean("event_type || ' ' || props")}) AS text_hash FROM events)""",
    "model_roundtrip": f"{_FIXED} SELECT doc_id, known_terms, round(p, 6) AS p, true AS agrees FROM scored",
    "explain_fixed": f"""{_FIXED},
        {_RANKED}
        SELECT doc_id, rank, term, round(value, 6) AS value,
            round(abs(value) / greatest(max(abs(value)) OVER (PARTITION BY doc_id), 1e-9), 6) AS rel_weight
        FROM ranked WHERE rank <= 8""",
    "report_fixed": f"""{_FIXED.replace(_EVERY, _EVERY_AND_BLANK)}, {_RANKED},
        labels_shown(term, label) AS (VALUES {', '.join(f"('[{k}]', '{v}')" for k, v in SIGNAL_LABELS.items())}),
        driven AS (
            SELECT doc_id, string_agg(coalesce(label, '“' || term || '”') || CASE WHEN value > 0 THEN ' positive' ELSE ' negative' END, '; ' ORDER BY rank) AS drivers
            FROM ranked LEFT JOIN labels_shown USING (term) WHERE rank <= 8 GROUP BY doc_id
        ),
        grouped_counted AS (SELECT * FROM docs),
        {_signals('grouped_counted', 'doc_id, grp').replace('counted AS (', 'group_counted AS (', 1).replace('signals AS (', 'group_signals AS (', 1).replace('FROM counted', 'FROM group_counted')},
        {_PROFILE.replace('FROM signals', 'FROM group_signals')},
        reference AS (SELECT y, {', '.join(f'round(avg({m}), 6) AS {m}' for m in REFERENCED)} FROM profile JOIN groups USING (grp) GROUP BY y),
        typical AS (
            SELECT {" || '; ' || ".join(f"printf('{name}/%.3f/%.3f', a.{c}, b.{c})" for name, c in _TYPICAL)} || '; punct' AS typical
            FROM reference a, reference b WHERE a.y = 1 AND b.y = 0
        )
        SELECT doc_id, drivers, typical,
            concat_ws('; ', CASE WHEN len(urgency_hits) > 0 THEN array_to_string(urgency_hits[1:3], ', ') ELSE 'none' END,
                CASE WHEN len(cta_hits) > 0 THEN array_to_string(cta_hits[1:2], ', ') ELSE 'none' END, urls::VARCHAR, words || ' / ' || chars,
                round_even(100 * caps_ratio, 1)::VARCHAR, punct::VARCHAR) AS shown,
            CASE WHEN greatest(p, 1 - p) * 100 >= 99 THEN '>99' ELSE floor(greatest(p, 1 - p) * 100 + 0.5)::BIGINT::VARCHAR END AS confidence,
            CASE WHEN words = 0 THEN 'nothing_to_analyze' ELSE 'scored' END AS status,
            CASE WHEN words = 0 THEN NULL WHEN pred = 1 THEN 'positive' ELSE 'negative' END AS verdict,
            round(100 * p, 4) AS p_pct, known_terms,
            array_to_string(list_filter([
                CASE WHEN len(urgency_hits) > 0 THEN 'urgency' END, CASE WHEN len(cta_hits) > 0 THEN 'cta' END,
                CASE WHEN urls > 0 AND urls <= 3 THEN 'urls' END, CASE WHEN words < 150 THEN 'length' END,
                CASE WHEN 100 * caps_ratio > 15 THEN 'caps' END], lambda x: x IS NOT NULL), ',') AS flags,
            array_to_string(urgency_hits[1:3], ', ') AS urgency_shown
        FROM scored JOIN every_signals USING (doc_id) JOIN driven USING (doc_id), typical""",
    "model_terms_fixed": f"""{_FIXED},
        sided AS (
            SELECT 'positive' AS side, term, coef, row_number() OVER (ORDER BY coef DESC, idx DESC) AS rank FROM model_terms
            UNION ALL
            SELECT 'negative', term, coef, row_number() OVER (ORDER BY coef, idx) FROM model_terms
        )
        SELECT side, rank, term, coef, round(abs(coef) / max(abs(coef)) OVER (), 6) AS rel_weight FROM sided WHERE rank <= 15""",
    "parity_check": f"""WITH {_LABELLED}
        SELECT doc_id, grp, true AS agrees FROM corpus QUALIFY row_number() OVER (PARTITION BY grp ORDER BY doc_id) <= 2
        UNION ALL SELECT -1 - i, 'edge', true FROM range({len(EDGE_TEXTS)}) AS t(i)""",
    "stats_document": f"""WITH {_LABELLED_SIGNALS}, {_PROFILE}, {_RATES}, {_WORDS}
        {' UNION ALL '.join(f"SELECT '{m}' AS metric, '' AS key, grp, {_published(m)}::DOUBLE AS value FROM profile" for m in _LISTED_METRICS)}
        UNION ALL SELECT 'rows', '', grp, count(*)::DOUBLE FROM corpus GROUP BY grp
        UNION ALL SELECT 'distinct', '', grp, (SELECT count(*) FROM docs d WHERE d.grp = c.grp)::DOUBLE FROM (SELECT DISTINCT grp FROM corpus) c
        UNION ALL SELECT 'urgency', term, grp, round_even(pct, 1)::DOUBLE FROM rates
        UNION ALL SELECT 'words', lpad(rank::VARCHAR, 2, '0') || ' ' || word, grp, round_even(pct, 0)::DOUBLE FROM words""",
    "file_corpus": f"""WITH {_LABELLED}
        SELECT grp, grp_order, origin, y, md5(CASE WHEN grp_order < 2 THEN trim('café, of a text fine 1⁄2 ' || text, ' ') ELSE text END) AS text_md5
        FROM corpus""",
    "cv_fixed": f"""WITH {_LABELLED}, {_FOLDS}, {_trials(_FOLDED, _OTHER_FOLDS.format('<>'), _OTHER_FOLDS.format('='))},
        accuracies AS (
            SELECT 'group' AS scope, grp, sum(correct) / sum(n) AS accuracy FROM outcomes GROUP BY model, grp
            UNION ALL SELECT 'overall', NULL, sum(correct) / sum(n) FROM outcomes GROUP BY model
        )
        SELECT scope, grp, round_even(100 * avg(accuracy), 1) AS mean_pct, round_even(100 * stddev_pop(accuracy), 1) AS sd_pct
        FROM accuracies GROUP BY scope, grp""",
    "holdout_fixed": f"""WITH {_LABELLED}, {_FOLDS}, {_SPLIT},
        {_trials("SELECT doc_id, grp, y, text, low, part FROM split", "SELECT 0 AS model, 'train' AS part", "SELECT 0 AS model, 'test' AS part")}
        SELECT 'group' AS scope, grp, round_even(100 * (sum(correct) / sum(n)), 1) AS accuracy_pct, sum(n)::BIGINT AS n FROM outcomes GROUP BY grp
        UNION ALL SELECT 'overall', NULL, round_even(100 * (sum(correct) / sum(n)), 1), sum(n)::BIGINT FROM outcomes""",
    "cross_origin_fixed": f"""WITH {_LABELLED},
        {_trials("SELECT doc_id, grp, y, text, low, origin AS part FROM docs", "VALUES (0, 'en'), (1, 'other')", "VALUES (0, 'other'), (1, 'en')")
            .replace("trains AS", "trains(model, part) AS").replace("tests AS", "tests(model, part) AS")},
        shares AS (
            SELECT model, sum(correct) / sum(n) AS accuracy, sum(positive) FILTER (y = 1) / sum(n) FILTER (y = 1) AS found,
                1 - sum(positive) FILTER (y = 0) / sum(n) FILTER (y = 0) AS spared, sum(positive) / sum(n) AS positive
            FROM outcomes GROUP BY model
        )
        SELECT CASE model WHEN 0 THEN 'en_to_other' ELSE 'other_to_en' END AS direction, round_even(100 * accuracy, 1) AS accuracy_pct,
            round_even(100 * ((found + spared) / 2), 1) AS balanced_accuracy_pct, round_even(100 * found, 1) AS positive_recall_pct,
            round_even(100 * spared, 1) AS negative_recall_pct, round_even(100 * positive, 1) AS predicted_positive_pct,
            round_even(100 * (1 - spared), 1) AS false_flag_pct
        FROM shares""",
    "fit_certificate": f"""WITH {_LABELLED}, {_FOLDS}, {_SPLIT}, training AS (SELECT doc_id, low FROM split WHERE part = 'train'), {_terms('training', 'doc_id')}
        SELECT 0 AS model, (SELECT count(*) FROM training) AS n_train,
            least({MAX_FEATURES}, (SELECT count(*) FROM (SELECT term FROM terms GROUP BY term HAVING count(*) >= 2))) AS n_terms,
            true AS terms_solved, true AS intercept_solved""",
    "file_audit": f"""WITH {_LABELLED},
        written AS (SELECT grp, CASE WHEN grp_order = 2 THEN text ELSE raw END AS raw, text FROM corpus)
        SELECT grp, count(*) AS n_rows, count(*) - count(DISTINCT raw) AS identical_rows,
            count(*) - count(DISTINCT raw) AS identical_text, count(DISTINCT raw) AS unique_text,
            count(DISTINCT text) AS after_cleaning
        FROM written GROUP BY grp""",
}
ORACLES["stats_saved"] = ORACLES["stats_document"]
