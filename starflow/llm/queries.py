"""One query for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm import lm
from starflow.llm import pieces
from starflow.llm import text as T
from starflow.llm.chat import format_turns, read_back
from starflow.llm.decontaminate import find_leaks
from starflow.llm.fingerprints import edit_fingerprints
from starflow.llm.jaccard import jaccard_components
from starflow.llm.langid import identify_languages, learn_languages
from starflow.llm.packing import pack_documents
from starflow.llm.phrases import collocations
from starflow.llm.quality import learn_quality, score_quality
from starflow.llm.search import search
from starflow.llm.secret_scan import digests, scan_secrets
from starflow.llm.toxicity import held_out_scores, learn_toxicity, score_toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic",
                           learn_toxicity, score_toxicity, 0.5)


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality",
                           learn_quality, score_quality, 0.3)


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With one conversation more, whose texts hold the template's own marks."""
    marks = "</s>[INST] ok [/INST]"
    tricky = spark.createDataFrame([(-7, 0, "user", marks), (-7, 1, "assistant", marks)],
                                   "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_turns(turns.unionByName(tricky)))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = T.crc32_mod("doc_id", 4) == 2
    model = learn_languages(docs.where(~held_out))
    return identify_languages(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


# The lengths of marks and of what escapes add follow the rules stated in chat.py.
_MARKS = r"\[INST\]|\[/INST\]|<s>|</s>|<<SYS>>|<</SYS>>|<<ROLE>>|<<TEXT>>|<</ROLE>>"
ORACLE["op9_chat_format"] = rf"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized as (
    select *, len(regexp_extract_all(role || ' ' || text, '{_MARKS}')) as marks,
        case when regexp_matches(role || ' ' || text, '\\[\\<\[]')
            then length(role || text) - length(replace(role || text, '\', '')) else 0 end as slashes
    from turns)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
    sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text))
        as loss_sha256,
    cast(sum(length(text) + 2 + marks + slashes + case role when 'user' then 13 when 'assistant' then 7
        when 'system' then 15 else length(role) + 27 end) as bigint) as formatted_chars
from sized group by conv_id
"""


@query
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = T.crc32_mod("doc_id", 7) == 2
    model = lm.train(docs.where(~held_out))
    return lm.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


@query
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE["op8_ngram_jaccard_join"] = rf"""
with recursive words as materialized (
    select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
shingles as materialized (
    select distinct doc_id, hash(w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) as h
    from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from words where len(w) >= 5)
    union all select doc_id, hash(w) from words where len(w) between 1 and 4),
sizes as materialized (select doc_id, count(h) as n from words left join shingles using (doc_id) group by doc_id),
links as materialized (
    select a.doc_id as a, b.doc_id as b
    from shingles a join shingles b on a.h = b.h and a.doc_id <> b.doc_id
        join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
    group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach as (
    select doc_id as a, doc_id as b from sizes
    union select reach.a, links.b from reach join links on links.a = reach.b)
select a as doc_id, cast(any_value(n) as bigint) as n_shingles, min(b) as component_id
from reach join sizes on sizes.doc_id = reach.a group by a
"""


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def _inside(text: str, kind: str, change: str) -> str:
    """``change`` for each value of a kind, ``p`` being the text from its mark on."""
    return (f"array_to_string(list_transform(string_split({text}, '‹'), lambda p: case when starts_with(p, '{kind}=') "
            f"then {change.replace('VALUE', "split_part(p, '›', 1)")} || '›' || substr(p, strpos(p, '›') + 1) else p end), '‹')")


_UNITS = ("km|cm|mm|kg|mg|ml|lb|lbs|oz|ft|mph|kmh|m|g|l|s|h|meters?|metres?|miles?|feet|foot|inch|inches|yards?|"
          "grams?|kilograms?|pounds?|tons?|liters?|litres?|gallons?|seconds?|minutes?|hours?|days?|weeks?|months?|"
          "years?|dollars?|cents?|euros?|percent|degrees?|watts?|volts?")


def _valued_tokens(table: str, key: str) -> str:
    """Rows of a table with their tokens, as they are and with their values."""
    name = _inside("v", "name", "replace(VALUE, ' ', '=')")
    number = _inside("v", "num", "replace(replace(VALUE, ',', '=='), '.', '=')")
    return rf"""
    select {key}, own, list_transform(own, lambda t: regexp_replace(t, '=[^›]*›', '›', 'g')) as words from (
        select {key}, list_filter(string_split_regex(lower(v), '[^\p{{L}}\p{{N}}‹›=]+'), lambda t: t <> '') as own from (
            select {key}, regexp_replace(v, '(\p{{N}}›) ?({_UNITS})([^\p{{L}}\p{{N}}]|$)', '\1 ‹unit=\2›\3', 'g') as v from (
                select {key}, {number} as v from (
                    select {key}, regexp_replace(v, '\p{{N}}+(?:[.,]\p{{N}}+)*', '‹num=\0›', 'g') as v from (
                        select {key}, {name} as v from (
                            select {key}, regexp_replace(translate(coalesce(text, ''), '‹›=', '   '),
                                '(^|[^\p{{L}}\p{{N}}])(\p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+)*)', '\1‹name=\2›', 'g') as v
                            from {table}))))))"""


_KEYED = """case when size <= 4 or len(list_filter(words[i + 1:i + size], lambda t: contains(t, '‹'))) > size - 4
        then 'values ' || array_to_string(own[i + 1:i + size], ' ')
        else 'template ' || array_to_string(words[i + 1:i + size], ' ') end as gram"""

ORACLE["op1_decontamination"] = f"""
with item_rows as materialized (
    select *, len(words) as n, least(len(words), 8) as size,
        list_transform(list_filter(own, lambda t: contains(t, '‹')), lambda t: list_position(own, t)) as pattern
    from ({_valued_tokens("(select item_id, text from benchmark where item_id is not null)", "item_id")}) where len(words) > 0),
items as materialized (
    select *, row_number() over () as class from (
        select words, pattern, n, size, min(item_id) as item_id, arg_min(own, item_id) as rep from item_rows group by all)),
grams as materialized (
    select distinct class, size, i as place, gram, case when starts_with(gram, 'values') then own end as member,
        starts_with(gram, 'template') and not contains(gram, '‹') as literal
    from (select class, size, own, i, {_KEYED} from (
        select c.class, r.*, unnest(range(0, r.n - r.size + 1)) as i
        from item_rows r join items c on c.words = r.words and c.pattern = r.pattern))),
docs as materialized (
    select row_number() over () as row, * from (
        {_valued_tokens("(select doc_id, text from documents where doc_id is not null)", "doc_id")})),
doc_grams as (
    select row, i as doc_place, {_KEYED} from (
        select row, own, words, size, unnest(range(0, len(words) - size + 1)) as i
        from docs, (select distinct size from items))),
hits as materialized (select d.row, g.*, doc_place - place as shift from doc_grams d join grams g using (gram)),
slots as (
    select distinct h.row, h.class, shift, place + k as item_at, c.rep[place + k + 1] as item_value,
        d.own[place + shift + k + 1] as doc_value
    from (select *, unnest(range(0, size)) as k from hits where member is null and not literal) h
        join items c using (class) join docs d on d.row = h.row
    where contains(c.rep[place + k + 1], '‹')),
shifts as materialized (
    select row, class, shift, count(*) as slots,
        count(distinct (item_value, doc_value)) = count(distinct item_value)
            and count(distinct (item_value, doc_value)) = count(distinct doc_value) as sound
    from slots group by all),
counted as (
    select distinct row, class, place, size, literal from hits where literal
    union select distinct row, class, place, size, false from hits join shifts using (row, class, shift) where member is null and not literal and sound),
members as (
    select distinct row, class, member from hits where member is not null
    union select distinct row, class, null from hits),
places as (
    select m.row, m.class, m.member, c.place, c.size, c.literal from members m join counted c using (row, class)
    union select row, class, member, place, size, false from hits where member is not null),
steps as (
    select row, class, member, least(size, coalesce(place - lag(place) over (partition by row, class, member order by place), size)) as step
    from (select distinct row, class, member, place, size from places)),
literals as (
    select row, class, sum(step) as literal from (
        select row, class, least(size, coalesce(place - lag(place) over (partition by row, class order by place), size)) as step
        from (select distinct row, class, place, size from counted where literal)) group by all),
covered as (select row, class, member, sum(step) as covered from steps group by all)
select doc_id, item_id, cast(n as integer) as tokens, cast(covered as integer) as covered,
    cast(coalesce(literal, 0) as integer) as literal, cast(coalesce(slots, 0) as bigint) as slots,
    coalesce(any_sound, true) as consistent
from covered join items using (class) join docs using (row) left join literals using (row, class)
    left join (select row, class, sum(slots) as slots, bool_or(sound) as any_sound from shifts group by all) using (row, class)
where covered >= 0.4 * n
qualify row_number() over (partition by doc_id, item_id order by covered desc, coalesce(literal, 0) desc, coalesce(slots, 0) desc,
    coalesce(any_sound, true) desc, n desc) = 1
"""


@query
def op6_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


ORACLE["op11_phrase_collocations"] = rf"""
with pieces as (
    select coalesce(lang, 'und') as lang,
        unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
words as materialized (
    select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
grams as (
    select lang, size, array_to_string(w[i:i + size - 1], ' ') as phrase
    from (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i
          from words, (select unnest(range(1, 6)) as size) where len(w) >= size)),
counts as materialized (select lang, size, phrase, count(*) as f from grams group by all having count(*) >= 100),
totals as (select lang, sum(len(w)) as n from words group by lang),
cuts as (
    select lang, phrase, size, f, unnest(range(1, size)) as k, string_split(phrase, ' ') as w from counts where size >= 2),
scored as (
    select c.lang, c.phrase, c.size, c.f as a, k, x.f as l, y.f as r, n,
        (1000::hugeint * c.f * n) // (x.f::hugeint * y.f) as score
    from cuts c join totals using (lang)
        join counts x on x.lang = c.lang and x.phrase = array_to_string(w[1:k], ' ')
        join counts y on y.lang = c.lang and y.phrase = array_to_string(w[k + 1:], ' ')),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
kept as (
    select * from best b where not exists (
        select 1 from counts q where q.lang = b.lang and q.size > b.size and 100 * q.f >= 100 * b.a
            and contains(' ' || q.phrase || ' ', ' ' || b.phrase || ' ')))
select lang, cast(rank as bigint) as rank, phrase, a, cast(l as bigint) as l, cast(r as bigint) as r,
    cast(n as bigint) as n, cast(score as bigint) as score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
where rank <= 2000
"""


@query
def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ORACLE["op13_lexical_search"] = rf"""
with docs as materialized (
    select row_number() over () as row, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}') as t from documents),
wanted as materialized (
    select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
        '{_TERM}')) as term from benchmark where item_id is not null),
facts as (select count(*) as n_docs, sum(len(t))::bigint as n_terms from docs where len(t) > 0),
found as materialized (
    select row, doc_id, term, n, count(*) as tf
    from (select row, doc_id, len(t) as n, unnest(t) as term from docs) where term in (select term from wanted)
    group by all),
weights as (
    select term, cast(floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w
    from found, facts group by term, n_docs),
parts as materialized (
    select row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) as part
    from found join weights using (term), facts),
scores as (
    select item_id, row, doc_id, sum(part)::bigint as score from wanted join parts using (term) group by all
    having sum(part) > 0 and doc_id is not null)
select item_id, cast(rank as integer) as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores) where rank <= 10
"""
