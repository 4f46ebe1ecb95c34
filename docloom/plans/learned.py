"""Registered queries of the learned tagger: its scores, what it finds, and how well on turns that it has not seen.

Annotations are made of the turns themselves, by a rule that looks at neighbours: a word with a capital is a drug, a long word after
it goes on with it, and a word before a comma is a biomarker.  The tagger sees words and tags of four fifths of the conversations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import evaluate, hmm, tagging
from docloom.plans.registry import query
from docloom.sources.tables import load

_CAPITAL = "^[A-ZÀ-ÖØ-ÞΑ-ΩА-Я]"


def annotated_turns(spark: SparkSession, base: str) -> DataFrame:
    rows = load(spark, base, "conversations").select("conv_id", "turn", "text", F.regexp_extract_all("text", F.lit(r"(\S+)")).alias("words"))
    # Words and those before them side by side: a lambda that looked back into the words would have them cut anew for each word, wherever a filter meets the tags.
    before = F.slice(F.concat(F.array(F.lit("")), F.col("words")), F.lit(1), F.size("words"))
    word, follows = lambda p: p["word"], lambda p: p["before"].rlike(_CAPITAL)
    tag = lambda p: F.when(word(p).rlike(_CAPITAL), "B-DRUG").when(follows(p) & (F.length(word(p)) > 5), "I-DRUG").when(F.endswith(word(p), F.lit(",")), "B-BIOMARKER").otherwise("O")
    tags = F.transform(F.arrays_zip(F.col("words").alias("word"), before.alias("before")), tag)
    return rows.withColumns({"tags": tags, "training": evaluate.in_training("conv_id")})


def _model(spark: SparkSession, base: str) -> hmm.Model:
    return hmm.learn(annotated_turns(spark, base).filter("training"))


def _extracted(spark: SparkSession, base: str) -> DataFrame:
    turns = load(spark, base, "conversations").select("conv_id", "turn", "text")
    return tagging.with_entities(hmm.tagged(turns, _model(spark, base), ["conv_id", "turn"]), text="text")


_SHAPE = rf"' ' || case when regexp_matches(word, '{_CAPITAL}') then 'A' when regexp_matches(word, '^[0-9]') then '0' else 'a' end || case when length(word) > 5 then 'long' else 'short' end || case when regexp_matches(word, '[.!?]$') then '.' when regexp_matches(word, '[,;:]$') then ',' else '' end"
_HMM = rf"""pieces as (select conv_id, turn, unnest(a) piece, generate_subscripts(a, 1) i from (select conv_id, turn, regexp_extract_all(text, '\s*\S+') a from conversations)),
 words as materialized (select conv_id, turn, i, regexp_extract(piece, '\S+') word, sum(length(piece)) over (partition by conv_id, turn order by i) e from pieces),
 shaped as (select *, {_SHAPE} shape, lag(word) over (partition by conv_id, turn order by i) prev_word from words),
 truth as materialized (select *, case when regexp_matches(word, '{_CAPITAL}') then 'B-DRUG' when coalesce(regexp_matches(prev_word, '{_CAPITAL}'), false) and length(word) > 5 then 'I-DRUG' when word like '%,' then 'B-BIOMARKER' else 'O' end tag from shaped),
 tr as materialized (select *, lag(tag) over (partition by conv_id, turn order by i) prev from truth where substr(md5('42:' || conv_id), 1, 4) < 'cccc'),
 tot as (select tag, count(*) total from tr group by 1), known as (select lower(word) form from tr group by 1 having count(*) >= 2),
 seen as materialized (select coalesce(k.form, shape) form, tag, count(*) n from tr left join known k on k.form = lower(word) group by 1, 2),
 many as (select count(distinct form) m from seen),
 em as materialized (select f.form, t.tag, round(1000000 * ln((coalesce(n, 0) + 1) / (total + m)))::bigint s from (select distinct form from seen) f cross join tot t left join seen using (form, tag) cross join many),
 unseen as (select tag, round(1000000 * ln(1 / (total + m)))::bigint s from tot cross join many),
 ways as (select prev, tag, count(*) n from tr group by 1, 2), ahead as (select prev, sum(n) total from ways group by 1),
 pr as materialized (select b.tag prev, t.tag, round(1000000 * ln((coalesce(n, 0) + 1) / (a.total + (select count(*) from tot))))::bigint s from tot b cross join tot t join ahead a on a.prev = b.tag left join ways w on w.prev = b.tag and w.tag = t.tag),
 fst as materialized (select t.tag, round(1000000 * ln((coalesce(n, 0) + 1) / (a.total + (select count(*) from tot))))::bigint s from tot t join ahead a on a.prev is null left join ways w on w.prev is null and w.tag = t.tag),
 sc as materialized (select w.conv_id, w.turn, w.i, t.tag, coalesce(e1.s, e2.s, u.s) s from truth w cross join tot t left join em e1 on e1.form = lower(word) and e1.tag = t.tag left join em e2 on e2.form = shape and e2.tag = t.tag join unseen u on u.tag = t.tag)"""
_VITERBI = f"""{_HMM}, v as (select conv_id, turn, 1::bigint i, sc.tag, sc.s + fst.s score, [sc.tag] path from sc join fst using (tag) where i = 1
 union all select conv_id, turn, i, tag, s - best.neg, list_append(best.path, tag) from (select v.conv_id, v.turn, sc.i, sc.tag, sc.s, min({{'neg': -(v.score + pr.s), 'prev': v.tag, 'path': v.path}}) best
 from v join pr on pr.prev = v.tag join sc on sc.conv_id = v.conv_id and sc.turn = v.turn and sc.i = v.i + 1 and sc.tag = pr.tag group by v.conv_id, v.turn, sc.i, sc.tag, sc.s)),
 ended as (select conv_id, turn, min({{'neg': -score, 'tag': tag, 'path': path}}) best from v where (conv_id, turn, i) in (select conv_id, turn, max(i) from words group by 1, 2) group by 1, 2),
 picked as materialized (select conv_id, turn, unnest(best.path) tag, generate_subscripts(best.path, 1) i from ended),
 chosen as (select p.*, lag(p.tag) over (partition by conv_id, turn order by i) before from picked p),
 sure as (select c.conv_id, c.turn, c.i, exp(max(case when sc.tag = c.tag then (sc.s + coalesce(pr.s, fst.s)) / 1e6 end)) / sum(exp((sc.s + coalesce(pr.s, fst.s)) / 1e6)) confidence
  from chosen c join sc using (conv_id, turn, i) left join pr on pr.prev = c.before and pr.tag = sc.tag join fst on fst.tag = sc.tag group by 1, 2, 3),
 tagged as materialized (select c.*, w.word, w.e, s.confidence from chosen c join words w using (conv_id, turn, i) join sure s using (conv_id, turn, i)),
 begun as (select *, sum(case when tag like 'B-%' or (tag like 'I-%' and (before is null or before = 'O' or before[3:] <> tag[3:])) then 1 else 0 end) over (partition by conv_id, turn order by i) n from tagged),
 spans as (select conv_id, turn, n, min(tag[3:]) entity_type, min(e - length(word)) start_position, max(e) end_position, list_reduce(list(confidence order by i), lambda a, b: (a + b) / 2) confidence from begun where tag <> 'O' group by 1, 2, 3)"""


@query("hmm_model", f"with {_HMM} select form, tag, s score from em")
def hmm_model(spark: SparkSession, base: str) -> DataFrame:
    """The learned scores of words and shapes."""
    model = _model(spark, base)
    pairs = F.arrays_zip(F.array(*map(F.lit, model.tags)).alias("tag"), F.col("scores").alias("score"))
    return model.forms.select("form", F.inline(pairs))


@query("ner_predict", f"with recursive {_VITERBI} select entity_type, substr(text, (start_position + 1)::bigint, (end_position - start_position)::bigint) entity_text, count(*) n from spans join conversations using (conv_id, turn) group by 1, 2")
def ner_predict(spark: SparkSession, base: str) -> DataFrame:
    return tagging.clinical_entities(_extracted(spark, base), ["conv_id", "turn"], "conv_id").groupBy("entity_type", "entity_text").agg(F.count("*").alias("n"))


@query("ner_extraction_summary", f"""with recursive {_VITERBI}, t as (select conv_id, turn, count(*) n from spans group by 1, 2), every as (select c.conv_id, c.turn, coalesce(n, 0) n from conversations c left join t using (conv_id, turn))
 select n entity_count, count(*) sections from every group by 1""")
def ner_extraction_summary(spark: SparkSession, base: str) -> DataFrame:
    return _extracted(spark, base).groupBy(F.col("entity_count").cast("long").alias("entity_count")).agg(F.count("*").alias("sections"))


@query("clinical_entities", f"""with recursive {_VITERBI} select conv_id || '_e' || lpad((row_number() over (partition by conv_id, turn order by n))::varchar, 4, '0') entity_id, conv_id, turn, substr(text, (start_position + 1)::bigint, (end_position - start_position)::bigint) entity_text, entity_type,
 start_position::int start_position, end_position::int end_position, round(confidence, 6) confidence from spans join conversations using (conv_id, turn)""")
def clinical_entities(spark: SparkSession, base: str) -> DataFrame:
    return tagging.clinical_entities(_extracted(spark, base), ["conv_id", "turn"], "conv_id").withColumn("confidence", F.round("confidence", 6))


@query("ner_held_out", f"""with recursive {_VITERBI}, pairs as (select t.tag truth, p.tag guess from truth t join picked p using (conv_id, turn, i) where substr(md5('42:' || t.conv_id), 1, 4) >= 'cccc'),
 labels as (select truth label from pairs union select guess from pairs), each as (select label, count(*) filter (truth = label) support, count(*) filter (guess = label) guessed, count(*) filter (truth = label and guess = label) hit from labels cross join pairs group by 1),
 ratios as (select *, case when guessed > 0 then hit / guessed else 0 end p, case when support > 0 then hit / support else 0 end r from each)
 select round(sum(p * support) / sum(support), 9) as precision, round(sum(r * support) / sum(support), 9) recall, round(sum(case when p + r > 0 then 2 * p * r / (p + r) else 0 end * support) / sum(support), 9) f1, round(sum(hit) / sum(support), 9) accuracy from ratios""")
def ner_held_out(spark: SparkSession, base: str) -> DataFrame:
    """Tags of words of the conversations that were not learned from, against the rule's."""
    rest = annotated_turns(spark, base).filter("not training")
    found = hmm.tagged(rest, _model(spark, base), ["conv_id", "turn"])
    pairs = found.select(F.inline(F.arrays_zip(F.col("tags").alias("truth"), F.transform("tokens", lambda t: t["label"]).alias("guess"))))
    scores = evaluate.weighted_scores(pairs, "truth", "guess")
    return scores.select(*[F.round(c, 9).alias(c) for c in scores.columns])
