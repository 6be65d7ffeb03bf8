"""The SQL form of the queries (DuckDB dialect)."""

from __future__ import annotations

from catalog import views as v
from msgloom.config import MESSAGE_KEYWORDS

SQL: dict[str, str] = {}

AFTER_KEPT = 1 << 62
AS_OF = f"timestamp '{v.AS_OF}'"
MESSAGES = "with " + v.MESSAGES_SQL
HEADERS = "with " + v.EVENTS_SQL


def any_of(words: list[str]) -> str:
    return f"regexp_matches(message, '{'|'.join(words)}', 'i')"


KEEP = any_of(v.SETTING["keep_keywords"])
REMOVE = any_of(v.SETTING["keywords_to_remove"])
VERIFICATION = "regexp_matches(message, '验证码|verification code', 'i')"


def count_of(pattern: str) -> str:
    return f"len(regexp_extract_all(message, '{pattern}'))"


AMOUNT = r"\p{Nd}+元|\p{Nd}+\.?\p{Nd}*万|\p{Nd}+\.?\p{Nd}*千|\p{Nd}+\.?\p{Nd}*\s?(?:yuan|dollar|usd|rmb|bucks|cny|￥|$)"
LENGTH = "length(message)"
WORDS = count_of(r"[^\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}]+")
DIGITS = count_of(r"\p{Nd}")
PUNCTUATION = count_of('[，。！？；："（）【】《》、·…—]')
AMOUNTS = count_of(AMOUNT)
DOLLAR_AMOUNTS = count_of(AMOUNT.replace("|$)", r"|\$)"))
SLASHES = count_of("/")
URLS = count_of("://")


def keyword_sum(words: list[str]) -> str:
    return "(" + " + ".join(f"contains(message, '{w}')::int" for w in words) + ")"


def filtered(rule: str) -> str:
    return f"""{MESSAGES},
judged as (
  select *, {KEEP} as keep, {REMOVE} as remove, {VERIFICATION} as verif from messages
)
select id, min(case when keep then row_no else row_no + {AFTER_KEPT} end) as ord, sign, md5(message) as digest
from judged where {rule}
group by id, message, sign, ts, label, keep"""


SQL["filter_messages"] = filtered("keep or (not remove and not verif)")
SQL["filter_messages_strict"] = filtered("keep or (not remove and verif)")
SQL["filter_messages_no_verification"] = filtered("not verif and (keep or not remove)")
SQL["filter_messages_off"] = f"{MESSAGES} select id, row_no as ord, sign, md5(message) as digest from messages"
SQL["message_counts"] = f"""{filtered("keep or (not remove and not verif)").replace("select id, min(", ", kept as (select id, min(", 1)})
select (select count(*) from messages) as rows_before, count(*) as rows_after, count(distinct id) as users,
       count(distinct sign) as signs
from kept"""
SQL["dedup_messages"] = "select lang as id, md5(text) as digest, min(doc_id) as row_no from documents group by lang, text"

SQL["message_measures"] = f"""{MESSAGES}
select row_no, {LENGTH} as message_length, {WORDS} as word_count, {DIGITS} as digit_count,
       {PUNCTUATION} as punctuation_count, {AMOUNTS} as amount_count, {DOLLAR_AMOUNTS} as dollar_amount_count,
       {SLASHES} as slash_count, {URLS} as url_count,
       {", ".join(f"{keyword_sum(words)} as {name}_count" for name, words in v.KEYWORDS.items())}
from messages"""
SQL["message_predicates"] = f"""{MESSAGES}
select row_no, {KEEP}::int as keep, {REMOVE}::int as remove, {VERIFICATION}::int as verification from messages"""

FLAGS = {
    "is_weekend": "coalesce((isodow(ts) >= 6)::int, 0)",
    "is_work_time": "coalesce((hour(ts) between 9 and 17)::int, 0)",
    "is_night": "coalesce((hour(ts) >= 22 or hour(ts) < 6)::int, 0)",
}
SQL["time_parts"] = f"""{HEADERS}
select row_no as ord, hour(ts) as hour, isodow(ts) - 1 as day_of_week,
       {", ".join(f"{x} as {name}" for name, x in FLAGS.items())}
from headers"""
SQL["time_parse"] = """
select event_id, strftime(case event_id % 5
    when 0 then date_trunc('second', ts) when 1 then date_trunc('second', ts)
    when 2 then date_trunc('day', ts)::timestamp when 3 then date_trunc('minute', ts) end, '%Y-%m-%d %H:%M:%S') as parsed
from events"""
SQL["decrypt_ids"] = f"{HEADERS} select row_no as ord, id from headers"
SQL["phone_codes"] = f"{HEADERS} select distinct id, substr(id, 4, 4) as area_code, substr(id, 1, 3) as carrier_code from headers"

TIME_STATS = f"""
  round(coalesce(avg(hour(ts)), 0), 6) as hour_mean, round(coalesce(stddev_samp(hour(ts)), 0), 6) as hour_std,
  count(distinct hour(ts)) as hour_nunique, count(distinct isodow(ts)) as day_of_week_nunique,
  {", ".join(f"round(avg({x}), 6) as {n}_mean, sum({x})::bigint as {n}_sum" for n, x in FLAGS.items())}"""


def keyword_stats(keywords: dict[str, list[str]]) -> str:
    return ", ".join(
        f"sum({keyword_sum(w)})::bigint as {n}_keyword_count_sum, round(avg({keyword_sum(w)}), 6) as {n}_keyword_count_mean"
        for n, w in keywords.items()
    )


def content_stats(keywords: dict[str, list[str]]) -> str:
    return f"""
  round(avg({LENGTH}), 6) as message_length_mean, round(coalesce(stddev_samp({LENGTH}), 0), 6) as message_length_std,
  min({LENGTH}) as message_length_min, max({LENGTH}) as message_length_max,
  round(avg({WORDS}), 6) as word_count_mean, round(coalesce(stddev_samp({WORDS}), 0), 6) as word_count_std,
  round(avg({DIGITS}), 6) as digit_count_mean, sum({DIGITS})::bigint as digit_count_sum,
  round(avg({PUNCTUATION}), 6) as punctuation_count_mean, sum({PUNCTUATION})::bigint as punctuation_count_sum,
  sum({AMOUNTS})::bigint as amount_count_sum,
  {keyword_stats(keywords)}"""


def days(micros: str) -> str:
    return f"(case when {micros} = 0 then 1 / 24.0::double else ({micros}) / 86400000000.0::double end)"


DISTRIBUTION_STATS = f"""
  count(message) as message_count, count(distinct sign) as sign_unique_count,
  sum({SLASHES})::bigint as slash_count, sum({URLS})::bigint as url_count,
  round(coalesce(count(message) / {days("epoch_us(max(ts)) - epoch_us(min(ts))")}, 0), 6) as message_frequency,
  round(coalesce({days(f"epoch_us({AS_OF}) - epoch_us(max(ts))")}, 0), 6) as days_since_last_message"""


def sign_ctes(table: str) -> str:
    return f"""
per_sign as (select id, sign, count(*) as n from {table} group by id, sign),
sign_stats as (
  select id, count(sign) as unique_signs, coalesce(sum(n) filter (sign is not null), 0)::bigint as total_messages,
         round(coalesce(count(sign) / nullif(sum(n) filter (sign is not null), 0)::double, 0), 6) as sign_diversity_ratio,
         round(coalesce(max(n) filter (sign is not null), 0) / sum(n)::double, 6) as dominant_sign_ratio
  from per_sign group by id
)"""


def area_ctes(table: str) -> str:
    return f"""
carriers as (
  select substr(id, 1, 3) as carrier_code, count(distinct id) as carrier_user_count,
         count(message) as carrier_message_count
  from {table} group by 1
)"""


SQL["time_features"] = f"{HEADERS} select id, {TIME_STATS} from headers group by id"
SQL["content_features"] = f"{MESSAGES} select id, {content_stats(MESSAGE_KEYWORDS)} from messages group by id"
SQL["keyword_features"] = f"{MESSAGES} select id, {keyword_stats(v.KEYWORDS)} from messages group by id"
SQL["sign_diversity"] = f"{HEADERS}, {sign_ctes('headers')} select * from sign_stats"
SQL["dominant_sign"] = f"""{HEADERS},
hot as (select id, case when row_no % 3 = 0 then '【hot】' else sign end as sign from headers),
{sign_ctes('hot')}
select id, unique_signs, dominant_sign_ratio from sign_stats"""
SQL["carrier_stats"] = f"{MESSAGES}, {area_ctes('messages')} select * from carriers"
SQL["area_features"] = f"""{MESSAGES}, {area_ctes('messages')}
select u.id, c.carrier_user_count, c.carrier_message_count
from (select distinct id from messages) u join carriers c on c.carrier_code = substr(u.id, 1, 3)"""
SQL["message_distribution"] = f"{MESSAGES} select id, {DISTRIBUTION_STATS} from messages group by id"
ALL_STATS_CTES = f"""{MESSAGES},
dated as (select * from messages where ts is not null),
{sign_ctes('dated')}, {area_ctes('dated')},
plain as (
  select id, {TIME_STATS}, {content_stats(v.KEYWORDS)}, {DISTRIBUTION_STATS} from dated group by id
),
all_statistics as (
  select p.*, s.* exclude (id), c.carrier_user_count, c.carrier_message_count
  from plain p join sign_stats s using (id) join carriers c on c.carrier_code = substr(p.id, 1, 3)
)"""
SQL["all_statistics"] = f"{ALL_STATS_CTES} select * from all_statistics"


def vocab_ctes(rows: str, where: str = "true") -> str:
    return f"""
seen as (
  select sign, row_number() over (order by id, ts desc nulls last, ord) as place from {rows} where sign is not null and {where}
),
vocab as (select sign, (row_number() over (order by min(place)) + 1)::int as sign_id from seen group by sign)"""


ORDERED = HEADERS + ", ordered as (select row_no as ord, * exclude (row_no) from headers)"
DAILY = HEADERS + """, ordered as (
  select row_no as ord, * exclude (row_no) replace (date_trunc('day', ts)::timestamp as ts) from headers)"""
SQL["sign_vocab"] = f"{ORDERED}, {vocab_ctes('ordered')} select sign, sign_id from vocab"
SQL["sign_vocab_round_trip"] = SQL["sign_vocab"]


def sequence_ctes(length: int, missing: int) -> str:
    return f"""
ranked as (
  select id, sign, row_number() over (partition by id order by ts desc nulls last, ord) - 1 as pos from ordered
),
encoded as (
  select id, pos, coalesce(sign_id, {missing}) as sign_id from ranked left join vocab using (sign) where pos < {length}
),
slots as (
  select u.id, p.pos::int as pos, coalesce(e.sign_id, 0)::int as sign_id
  from (select distinct id from ordered) u
  cross join (select unnest(range({length})) as pos) p
  left join encoded e on e.id = u.id and e.pos = p.pos
)"""


SQL["sign_sequences_train"] = f"{DAILY}, {vocab_ctes('ordered')}, {sequence_ctes(50, 0)} select * from slots"
SQL["sign_sequences_infer"] = f"""{DAILY},
{vocab_ctes('ordered', "(sign like '%view%' or sign like '%click%')")}, {sequence_ctes(20, 1)}
select * from slots"""

for _name, _function in {"mean": "avg", "max": "max", "min": "min", "sum": "sum"}.items():
    SQL[f"pool_{_name}"] = f"""with {v.VECTORS_SQL},
each as (
  select id, unnest(embedding)::double as x, (generate_subscripts(embedding, 1) - 1)::int as pos from message_vectors
)
select id, pos, round({_function}(x), 6) as value from each group by id, pos"""

# Han characters are set apart first: this regular expression dialect has no class intersection.
TOKEN = r"[\p{L}\p{M}\p{N}]+(?:\.\p{Nd}+)*|[^\p{L}\p{M}\p{N}\p{Z}\s]"
NOISE = r"^(?:\.*\p{Nd}[\p{Nd}.]*|[，。！？；：（）【】《》、·…—\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]*)$"


def tokens_of(expression: str) -> str:
    return rf"regexp_extract_all(regexp_replace({expression}, '(\p{{Han}})', ' \1 ', 'g'), '{TOKEN}')"


def clean(tokens: str, stop: bool = True) -> str:
    listed = ", ".join(f"'{w}'" for w in v.STOPWORDS)
    stopped = f" and t not in ({listed})" if stop else ""
    return f"list_filter({tokens}, lambda t: not regexp_matches(t, '{NOISE}'){stopped})"


DIGEST = "len(tokens)::int as n, md5(array_to_string(tokens, ' ')) as digest"
SQL["tokens"] = f"""{MESSAGES}, split as (select row_no as ord, {tokens_of('message')} as tokens from messages)
select ord, {DIGEST} from split"""
SQL["token_filter"] = f"""{MESSAGES},
split as (select row_no as ord, {clean(tokens_of('lower(message)'))} as tokens from messages)
select ord, {DIGEST} from split"""

SOURCES = "with " + v.SOURCE_TEXTS_SQL
SQL["stopword_anti_join"] = f"""{SOURCES},
stop as (select list(distinct w) as words from (select unnest({tokens_of('lower(text)')}) as w from benchmark)),
split as (
  select ord, list_filter({clean(tokens_of('lower(message)'), stop=False)}, lambda t: not list_contains(words, t)) as tokens
  from source_texts, stop
)
select ord, {DIGEST} from split"""
SQL["user_text"] = f"""{MESSAGES}
select id, row_no as ord, coalesce(sum(length(message) + 1) over (
         partition by id order by row_no rows between unbounded preceding and 1 preceding), 0)::bigint as start,
       md5(message) as digest
from messages"""

SOURCE_TOKENS = f"""{SOURCES},
split as (select id, ord, {clean(tokens_of('lower(message)'))} as tokens from source_texts),
each as (select id, ord, unnest(tokens) as w, generate_subscripts(tokens, 1) as pos from split),
placed as (
  select id, w, lead(w, 1) over (partition by id order by ord, pos) as w2,
         lead(w, 2) over (partition by id order by ord, pos) as w3
  from each
)"""
NGRAMS = f"""{SOURCE_TOKENS},
terms as (
  select id, w as term from placed
  union all
  select id, concat(w, ' ', w2) from placed where w2 is not null
),
per_user as (select id, term, count(*) as tf from terms group by id, term),
stats as (select term, count(*) as df, sum(tf)::bigint as cf from per_user group by term)"""
SQL["ngram_counts"] = f"{NGRAMS} select * from stats"
SQL["trigram_counts"] = f"""{SOURCE_TOKENS},
per_user as (
  select id, concat(w, ' ', w2, ' ', w3) as term, count(*) as tf from placed where w3 is not null group by 1, 2
)
select term, count(*) as df, sum(tf)::bigint as cf from per_user group by term"""
TFIDF = f"""{NGRAMS},
n as (select count(distinct id) as n from split),
chosen as (
  select term, df from stats, n where df >= 2 and df <= 0.95 * n order by cf desc, term limit 300
),
vocab as (
  select term, (row_number() over (order by term) - 1)::int as idx, ln((1.0::double + n) / (1 + df)) + 1 as idf
  from chosen, n
),
raw as (select id, idx, (ln(tf) + 1) * idf as x from per_user join vocab using (term)),
weights as (select id, idx, x / sqrt(sum(x * x) over (partition by id)) as w from raw)"""
SQL["tfidf_vocab"] = f"{TFIDF} select term, idx, round(idf, 6) as idf from vocab"
SQL["tfidf_weights"] = f"{TFIDF} select id, idx, round(w, 6) as w from weights"
SQL["tfidf_vectors"] = f"""{TFIDF}
select u.id, v.idx, round(coalesce(w, 0), 6) as w
from (select distinct id from split) u cross join vocab v left join weights x on x.id = u.id and x.idx = v.idx"""
SQL["w2v_user_vector"] = f"""{SOURCES},
split as (select id, {clean(tokens_of('message'), stop=False)} as tokens from source_texts),
each as (select id, unnest(tokens) as w from split),
known as (
  select w, i, ('0x' || substr(md5(w), 1 + 8 * i, 8))::bigint % 1000 / 1000.0::double as x
  from (select w from each group by w having count(*) >= 2), (select unnest(range(4))::int as i)
)
select id, i as pos, round(avg(x), 6) as value from each join known using (w) group by id, i"""

SQL["encoder_means"] = f"""{SOURCES},
split as (select ord, {clean(tokens_of('message'), stop=False)} as tokens from source_texts),
each as (select ord, unnest(tokens) as w from split),
counts as (select w, count(*) as n from each group by w),
known as (
  select w, i, ('0x' || substr(md5(w), 1 + 8 * i, 8))::bigint % 1000 / 1000.0::double
         * (0.001::double / (0.001::double + n / (select sum(n) from counts)::double)) as x
  from counts, (select unnest(range(4))::int as i) where n >= 2
),
means as (select ord, i, avg(x) as value from each join known using (w) group by ord, i)
select s.ord, p.i as pos, round(coalesce(value, 0), 6) as value
from split s cross join (select unnest(range(4))::int as i) p left join means m on m.ord = s.ord and m.i = p.i"""

LETTERS = "abcdefghijklmnopqrstuvwxyz"
SQL["embed_messages_encoder"] = f"""{SOURCES},
counts as (
  select ord, (unnest(range(26)))::int as pos, lower(message) as m from source_texts
)
select ord, pos, (length(m) - length(replace(m, substr('{LETTERS}', pos + 1, 1), '')))::double as value from counts"""

SQL["label_join"] = f"""{HEADERS}, {sign_ctes('headers')}
select s.*, l.label from sign_stats s left join (select id, max(label) as label from headers group by id) l using (id)"""
SQL["label_fanout"] = f"{HEADERS}, {sign_ctes('headers')} select s.*, h.label from sign_stats s left join headers h using (id)"
SQL["split_users"] = f"""{HEADERS}
select distinct id, case when ('0x' || substr(md5(id), 1, 8))::bigint % 10 < 2 then 1 else 0 end as held_out from headers"""

SCORES = "with " + v.SCORES_SQL
SQL["confusion_metrics"] = f"""{SCORES},
c as (
  select count(*) filter (score > 0.5 and label = 1) as tp, count(*) filter (score > 0.5 and label <> 1) as fp,
         count(*) filter (score <= 0.5 and label = 1) as fn, count(*) filter (score <= 0.5 and label <> 1) as tn
  from scores
)
select tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn)::double, 6) as accuracy,
       round(2 * tp / (2 * tp + fp + fn)::double, 6) as f1, round(tp / (tp + fn)::double, 6) as recall
from c"""
# compares every pair of distinct scores
SQL["roc_auc"] = f"""{SCORES},
g as (select score, count(*) filter (label = 1) as p, count(*) filter (label <> 1) as n from scores group by score)
select round(sum(a.p * b.n * case when a.score > b.score then 1.0::double when a.score = b.score then 0.5 else 0 end)
             / ((select sum(p) from g) * (select sum(n) from g)), 6) as auc
from g a cross join g b"""
SQL["ks_stat"] = f"""{SCORES},
g as (select score, count(*) filter (label = 1) as p, count(*) filter (label <> 1) as n from scores group by score),
d as (
  select a.score, sum(b.n) / (select sum(n) from g)::double as f0, sum(b.p) / (select sum(p) from g)::double as f1
  from g a join g b on b.score <= a.score group by a.score
)
select round(max(abs(f0 - f1)), 6) as ks from d"""

SQL["csv_round_trip"] = """
select cast(doc_id as varchar) as id, md5(text) as digest, source as sign, '2024-01-01' as datetime from documents"""
SQL["features_csv_round_trip"] = f"""{ORDERED}, {sign_ctes('ordered')}, {vocab_ctes('ordered')}, {sequence_ctes(50, 0)}
select s.id, s.unique_signs, s.total_messages, s.sign_diversity_ratio, s.dominant_sign_ratio, x.pos, x.sign_id
from sign_stats s join slots x using (id)"""

SQL["incremental_statistics"] = SQL["all_statistics"]
SQL["distinct_over_batches"] = SQL["dedup_messages"]

SQL["sign_gradient"] = f"""{ORDERED}, {vocab_ctes('ordered')}, {sequence_ctes(50, 0)},
labelled as (select id, max(label)::double as label from ordered where id is not null group by 1 having max(label) is not null),
shares as (select s.id, sign_id, count(*) / 50.0::double as share from slots s where sign_id <> 0 group by 1, 2),
given as (
  select sign_id, sum(('0x' || substr(md5('sign ' || sign_id), 1 + 8 * i, 8))::bigint % 1000 / 1000.0::double * w) as x
  from (select distinct sign_id from shares), (values (0, 0.5::double), (1, -0.25::double), (2, 0.75::double), (3, 1.0::double)) t(i, w) group by 1
),
logits as (select l.id, l.label, 0.1::double + coalesce(sum(share * x), 0) as logit from labelled l left join (shares join given using (sign_id)) k on k.id = l.id group by 1, 2),
judged as (select id, 1 / (1 + exp(-logit)) - label as error from logits)
select sign_id, round(sum(share * error) / (select count(*) from judged), 9) as g from shares join judged using (id) group by 1"""

# --- learned parts: what can be known of them exactly -------------------------------------
SQL["w2v_fit"] = f"""{SOURCES},
split as (select id, {clean(tokens_of('message'), stop=False)} as tokens from source_texts),
each as (select unnest(tokens) as word from split)
select word, 300 as size from each group by word having count(*) >= 2"""
LEXICON = f"""{MESSAGES},
runs as (select run, count(*) as times from (select unnest(regexp_extract_all(message, '\\p{{Han}}+')) as run from messages) group by 1),
starts as (select run, times, length, unnest(range(1, length(run) - length + 2)) as i from runs, range(1, 5) lengths(length)),
grams as (
  select run[i:i + length - 1] as gram, length, case when i > 1 then run[i - 1:i - 1] else '' end as before, run[i + length:i + length] as after, times
  from starts where i + length - 1 <= length(run)
),
totals as (select gram, length, sum(times)::bigint as n from grams group by 1, 2),
everything as (select sum(n)::double as total from totals where length = 1),
varied as (
  select gram, min(entropy) as entropy from (
    select gram, side, ln(sum(n)) - sum(n * ln(n)) / sum(n) as entropy
    from (select gram, 'before' as side, before as neighbour, sum(times)::double as n from grams group by all
          union all select gram, 'after', after, sum(times)::double from grams group by all)
    group by 1, 2)
  group by 1
),
cuts as (select gram, n, unnest(range(1, length)) as cut from totals where length > 1),
cohesions as (
  select c.gram, min(ln(c.n::double * total / (l.n::double * r.n))) as cohesion
  from cuts c join totals l on l.gram = c.gram[1:cut] join totals r on r.gram = substr(c.gram, (cut + 1)::bigint), everything group by 1
),
scored as (
  select gram, length::int as length, n, coalesce(cohesion, 0.0::double) as cohesion, entropy, ln(n / total) as logp
  from totals join varied using (gram) left join cohesions using (gram), everything
)"""
SQL["lexicon_scores"] = f"""{LEXICON}
select gram, length, n, round(cohesion, 6) + 0.0::double as cohesion, round(greatest(entropy, 0), 6) + 0.0::double as entropy,
       round(logp, 6) + 0.0::double as logp from scored"""


def ratio_ctes(min_count: int) -> str:
    """Co-occurrence weights of frequent words and their positive log ratios."""
    return f"""{SOURCES},
split as (select ord, {clean(tokens_of('message'), stop=False)} as tokens from source_texts),
each as (select ord, unnest(tokens) as w, generate_subscripts(tokens, 1) as pos from split),
frequent as (select w from each group by w having count(*) >= {min_count}),
neighbours as (
  select a.w as x, b.w as y, sum(6 - (b.pos - a.pos)) as weight
  from each a join each b on a.ord = b.ord and b.pos > a.pos and b.pos <= a.pos + 5 group by 1, 2
),
pairs as (
  select word, context, sum(weight)::bigint as weight
  from (select x as word, y as context, weight from neighbours union all select y, x, weight from neighbours)
  where word in (select w from frequent) and context in (select w from frequent) group by 1, 2
),
margins as (select word, sum(weight)::double as weight from pairs group by 1),
ratios as (
  select p.word, p.context, ln(p.weight::double * (select sum(weight) from margins) / (a.weight * b.weight)) as value
  from pairs p join margins a on a.word = p.word join margins b on b.word = p.context
)"""


SQL["cooccurrence_words"] = f"""{ratio_ctes(2)}
select p.word, count(*) as contexts, sum(p.weight)::bigint as weight, count(*) filter (where r.value > 0) as positive,
       round(coalesce(sum(r.value) filter (where r.value > 0), 0), 6) as ratios
from pairs p join ratios r using (word, context) group by 1"""
SQL["svd_reconstruction"] = f"{ratio_ctes(150)} select word, context, round(value, 4) as value from ratios where value > 0"
SQL["embed_messages"] = f"""{SOURCES}
select ord, 64 as size, (len({tokens_of('lower(message)')}) > 0)::int::double as norm from source_texts"""
SQL["sign_embedding"] = f"{HEADERS} select distinct id, 8 as size from headers where ts is not null"

# --- the whole pipeline on filtered messages ----------------------------------------------
CLEANED = MESSAGES.replace("messages as (", "all_messages as (") + f""",
messages as (
  select min(case when keep then row_no else row_no + {AFTER_KEPT} end) as row_no, id, message, sign, ts, label
  from (select *, {KEEP} as keep, {REMOVE} as remove, {VERIFICATION} as verif from all_messages)
  where keep or (not remove and not verif)
  group by id, message, sign, ts, label, keep
)"""
PIPELINE = ALL_STATS_CTES.replace(MESSAGES, CLEANED)
STATS_NAMES = """hour_mean hour_std hour_nunique day_of_week_nunique is_weekend_mean is_weekend_sum is_work_time_mean
  is_work_time_sum is_night_mean is_night_sum message_length_mean message_length_std message_length_min message_length_max
  word_count_mean word_count_std digit_count_mean digit_count_sum punctuation_count_mean punctuation_count_sum
  amount_count_sum loan_keyword_count_sum loan_keyword_count_mean risk_keyword_count_sum risk_keyword_count_mean
  promo_keyword_count_sum promo_keyword_count_mean unique_signs total_messages sign_diversity_ratio dominant_sign_ratio
  carrier_user_count carrier_message_count message_count sign_unique_count slash_count url_count message_frequency
  days_since_last_message""".split()
NUMBERS = f"""numbers as (
  select p.id, {", ".join(f"coalesce({c}, 0)::double as {c}" for c in STATS_NAMES)}
  from people p left join all_statistics a on a.id = p.id
)"""
NUMBER_ROWS = """
select id, name, 0 as pos, round(value, 6) as value from (unpivot numbers on columns(* exclude (id)) into name name value value)"""
SQL["feature_join"] = f"""{ALL_STATS_CTES},
message_vectors as (
  select h.id, unnest(e.embedding)::double as x, (generate_subscripts(e.embedding, 1) - 1)::int as pos
  from headers h join embeddings e on e.vec_id = h.row_no % (select count(*) from embeddings)
),
pooled as (select id, pos, avg(x) as mean, max(x) as most from message_vectors group by id, pos),
ordered as (select row_no as ord, * exclude (row_no) from headers),
{vocab_ctes('ordered')}, {sequence_ctes(50, 0)},
people as (select distinct id from pooled), {NUMBERS}
{NUMBER_ROWS}
union all select id, 'label', 0, max(label)::double from headers group by id
union all select id, 'sign_id_seq', pos, sign_id::double from slots
union all select id, 'embedding', pos, round(mean, 6) from pooled
union all select id, 'static_vec', pos, round(most, 6) from pooled"""
SQL["user_features_word2vec"] = f"""{PIPELINE}
select u.id, 32 as static_vec_size, 64 as embedding_size, 50 as sign_id_seq_size,
       coalesce(a.message_count, 0) as message_count, coalesce(a.hour_mean, 0) as hour_mean,
       coalesce(a.message_length_mean, 0) as message_length_mean
from (select distinct id from messages) u left join all_statistics a using (id)"""
SQL["train_score"] = f"{CLEANED} select distinct id, true as valid from messages"
ON_CLEANED = NGRAMS[len(SOURCES):].replace("source_texts", "ordered")
SQL["user_features_tfidf"] = f"""{PIPELINE},
ordered as (select row_no as ord, * exclude (row_no) from messages),
{vocab_ctes('ordered')}, {sequence_ctes(50, 0)}{ON_CLEANED}{TFIDF[len(NGRAMS):]},
people as (select distinct id from messages),
{NUMBERS},
letters as (
  select id, pos, avg(length(m) - length(replace(m, substr('{LETTERS}', pos + 1, 1), ''))) as x
  from (select id, lower(message) as m, unnest(range(26))::int as pos from messages) group by id, pos
)
{NUMBER_ROWS}
union all select id, 'label', 0, max(label)::double from all_messages where id in (select id from people) group by id
union all select id, 'sign_id_seq', pos, sign_id::double from slots
union all select id, 'embedding', pos, round(x, 6) from letters
union all select p.id, 'static_vec', v.idx, round(coalesce(w, 0), 6)
from people p cross join vocab_terms v left join weights x on x.id = p.id and x.idx = v.idx"""
SQL["user_features_tfidf"] = SQL["user_features_tfidf"].replace("\nvocab as (\n  select term,", "\nvocab_terms as (\n  select term,").replace(
    "from per_user join vocab using (term)", "from per_user join vocab_terms using (term)"
)
