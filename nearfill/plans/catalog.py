"""Registered queries over the test tables and their DuckDB oracle SQL.

Every query reads whole tables through ``inputs`` and runs the library's
operators; doubles are rounded to 6 decimals on both sides so that
summation order does not change the value hash.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..operators import (classify, clustering, impute_kmeans, impute_knn, metrics, neighbors, sampling, scaling,
                         select, stats, steps)
from ..operators.select import digamma_sql
from ..session import ensure_checkpoint_dir
from ..sources import load_splits, read_checked, read_table, write_table
from . import inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns({f.name: F.round(F.col(f.name), digits) for f in df.schema.fields
                           if isinstance(f.dataType, (DoubleType, FloatType))})


def _shared(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, for queries that write and read tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------------------
# Oracle-side projections: the same stand-in inputs as ``inputs``.
SQL_ORDERS = """
  select o_orderkey, o_orderstatus, o_orderpriority,
         case when o_orderkey % 7 = 0 then 0.0 else o_totalprice end as price,
         cast(o_custkey as double) as custkey,
         cast(date_diff('day', DATE '1995-01-01', cast(o_orderdate as date)) as double) as days
  from orders"""
SQL_CUSTOMER = """
  select c_custkey, c_mktsegment,
         case when c_custkey % 7 = 0 then 0.0 else c_acctbal end as acctbal,
         cast(c_nationkey as double) as nation, cast(c_custkey as double) as custno
  from customer"""
SQL_DOCS = """
  select l.doc_id, cast(l.quality as integer) as quality, cast(l.toxic as integer) as toxic,
         cast(d.n_chars as double) as n_chars,
         cast(length(d.text) - length(replace(d.text, ' ', '')) + 1 as double) as n_words,
         cast(length(d.text) - length(replace(d.text, chr(10), '')) + 1 as double) as n_lines,
         cast(length(d.text) - length(regexp_replace(d.text, '[0-9]', '', 'g')) as double) as n_digits
  from labels l join documents d on l.doc_id = d.doc_id"""

LINE_COLS = ["l_discount", "l_tax"]


# --------------------------------------------------------------------------- AG-01
@register("global_medians", """
select 'l_discount' as "column", round(median(l_discount) filter (where l_discount <> 0), 6) as median from lineitem
union all
select 'l_tax', round(median(l_tax) filter (where l_tax <> 0), 6) from lineitem
""")
def q_global_medians(spark, sf_dir):
    """AG-01: global median of the non-zero discount and tax values."""
    return stats.global_medians(inputs.lineitem_frame(spark, sf_dir), LINE_COLS)


# --------------------------------------------------------------------------- AG-02
@register("class_medians", """
select l_returnflag, 'l_discount' as "column", round(median(l_discount) filter (where l_discount <> 0), 6) as median
from lineitem group by l_returnflag
union all
select l_returnflag, 'l_tax', round(median(l_tax) filter (where l_tax <> 0), 6) from lineitem group by l_returnflag
""")
def q_class_medians(spark, sf_dir):
    """AG-02: per return-flag median of the non-zero discount and tax values."""
    return stats.class_medians(inputs.lineitem_frame(spark, sf_dir), "l_returnflag", LINE_COLS)


# --------------------------------------------------------------------------- AG-03
@register("median_fill", f"""
with src as ({SQL_ORDERS}),
g as (select median(price) filter (where price <> 0) as gm from src),
c as (select o_orderstatus, median(price) filter (where price <> 0) as cm from src group by o_orderstatus)
select o_orderkey, o_orderstatus,
       round(case when price = 0 then coalesce(cm, gm, 0.0) else price end, 6) as price
from src left join c using (o_orderstatus) cross join g
""")
def q_median_fill(spark, sf_dir):
    """AG-03: sentinel prices replaced by the median of the order-status class."""
    o = inputs.orders_frame(spark, sf_dir)
    glob = stats.global_medians(o, ["price"])
    med = stats.class_medians(o, "o_orderstatus", ["price"], fallback=glob)
    return stats.median_fill(o, ["price"], med, ["o_orderstatus"], global_fallback=glob).select(
        "o_orderkey", "o_orderstatus", "price")


# --------------------------------------------------------------------------- AG-05
@register("imputation_profile", """
with c as (
  select l_returnflag,
         median(l_discount) filter (where l_discount <> 0) as md,
         median(l_tax) filter (where l_tax <> 0) as mt
  from lineitem group by l_returnflag),
imp as (
  select case when l_discount = 0 then c.md else l_discount end as l_discount,
         case when l_tax = 0 then c.mt else l_tax end as l_tax
  from lineitem join c using (l_returnflag)),
o as (select * from lineitem)
select 'l_discount' as "column",
       (select count(*) from o where l_discount = 0) as zeros_replaced,
       round((select avg(l_discount) from o where l_discount <> 0), 6) as original_mean,
       round((select avg(l_discount) from imp), 6) as imputed_mean,
       round((select median(l_discount) from o where l_discount <> 0), 6) as original_median,
       round((select median(l_discount) from imp), 6) as imputed_median
union all
select 'l_tax',
       (select count(*) from o where l_tax = 0),
       round((select avg(l_tax) from o where l_tax <> 0), 6),
       round((select avg(l_tax) from imp), 6),
       round((select median(l_tax) from o where l_tax <> 0), 6),
       round((select median(l_tax) from imp), 6)
""")
def q_imputation_profile(spark, sf_dir):
    """PF-04/05 + AG-05: zeros in discount and tax filled with the return-flag
    median, then profiled before and after."""
    li = inputs.lineitem_frame(spark, sf_dir)
    med = stats.class_medians(li, "l_returnflag", LINE_COLS)
    filled = stats.median_fill(li, LINE_COLS, med, ["l_returnflag"])
    return stats.imputation_profile(li, filled, LINE_COLS)


# --------------------------------------------------------------------------- SC-01/02
ORDER_FEATURES = ["price", "custkey", "days"]


def _scale_sql(src: str, cols: list[str], key: str, by: str | None = None) -> str:
    stats_cols = ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in cols)
    outs = ", ".join(f"round(({c} - m_{c}) / case when s_{c} = 0 then 1 else s_{c} end, 6) as {c}" for c in cols)
    if by:
        return (f"with src as ({src}), p as (select {by}, {stats_cols} from src group by {by}) "
                f"select {key}, {by}, {outs} from src join p using ({by})")
    return f"with src as ({src}), p as (select {stats_cols} from src) select {key}, {outs} from src cross join p"


@register("standard_scale", _scale_sql(SQL_ORDERS, ORDER_FEATURES, "o_orderkey"))
def q_standard_scale(spark, sf_dir):
    """SC-01/02: global population z-scores of price (zeros kept), customer and day number."""
    o = inputs.orders_frame(spark, sf_dir)
    sc = scaling.fit_scaler(o, ORDER_FEATURES)
    return scaling.apply_scaler(o, ORDER_FEATURES, sc).select("o_orderkey", *ORDER_FEATURES)


CUST_FEATURES = ["acctbal", "nation", "custno"]


@register("standard_scale_by_class", _scale_sql(SQL_CUSTOMER, CUST_FEATURES, "c_custkey", "c_mktsegment"))
def q_standard_scale_by_class(spark, sf_dir):
    """SC-01/02 per class: z-scores within each market segment."""
    c = inputs.customer_frame(spark, sf_dir)
    sc = scaling.fit_scaler(c, CUST_FEATURES, ["c_mktsegment"])
    return scaling.apply_scaler(c, CUST_FEATURES, sc, ["c_mktsegment"]).select(
        "c_custkey", "c_mktsegment", *CUST_FEATURES)


@register("scaler_fit", f"""
with src as ({SQL_CUSTOMER})
select c_mktsegment, 'acctbal' as "column", round(avg(acctbal), 6) as mean,
       round(case when stddev_pop(acctbal) = 0 then 1 else stddev_pop(acctbal) end, 6) as scale
from src group by 1
union all
select c_mktsegment, 'nation', round(avg(nation), 6),
       round(case when stddev_pop(nation) = 0 then 1 else stddev_pop(nation) end, 6) from src group by 1
union all
select c_mktsegment, 'custno', round(avg(custno), 6),
       round(case when stddev_pop(custno) = 0 then 1 else stddev_pop(custno) end, 6) from src group by 1
""")
def q_scaler_fit(spark, sf_dir):
    """SC-01: the fitted per-segment scaler table (mean, population sd)."""
    return scaling.fit_scaler(inputs.customer_frame(spark, sf_dir), CUST_FEATURES, ["c_mktsegment"])


# --------------------------------------------------------------------------- S-01, AG-04, S-02
def _rank_sql(src: str, target: str, key: str, seed: int = 42) -> str:
    return (f"select *, row_number() over (partition by {target} "
            f"order by md5(concat_ws('|', '{seed}', cast({key} as varchar))), {key}) as rn from ({src})")


def _split_sql(src: str, target: str, key: str, cols: str, test_size: float = 0.2, seed: int = 42) -> str:
    return f"""
with r as ({_rank_sql(src, target, key, seed)}),
cnt as (select {target} as cls, count(*) as c from r group by 1),
tot as (select sum(c) as n, cast(ceil({test_size} * sum(c)) as bigint) as n_test from cnt),
q as (select cls, c * 1.0 / n * (n - n_test) as cont from cnt, tot),
q2 as (select cls, cont, floor(cont) as fl, cont - floor(cont) as rem from q),
nd as (select (select n - n_test from tot) - sum(fl) as k from q2),
q3 as (select cls, fl, row_number() over (order by rem desc, cls) as rr from q2),
quota as (select cls, fl + case when rr <= (select k from nd) then 1 else 0 end as train_q from q3)
select {cols}, case when rn <= train_q then 'train' else 'test' end as split
from r join quota on r.{target} = quota.cls"""


@register("stratified_split", _split_sql(
    "select o_orderkey, o_orderstatus from orders", "o_orderstatus", "o_orderkey", "o_orderkey, o_orderstatus"))
def q_stratified_split(spark, sf_dir):
    """S-01: exact 80/20 split of orders stratified by status, seed 42."""
    o = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.stratified_split(o, "o_orderstatus", ["o_orderkey"], 0.2, 42)


@register("split_profile", f"""
with s as ({_split_sql("select doc_id, quality from labels", "quality", "doc_id", "doc_id, quality")})
select split, count(*) as total, cast(sum(quality) as bigint) as positive,
       cast(count(*) - sum(quality) as bigint) as negative, round(avg(quality), 6) as positive_ratio
from s group by split
""")
def q_split_profile(spark, sf_dir):
    """S-01 + AG-04: split of the labels by quality and its class profile."""
    lab = inputs.table(spark, sf_dir, "labels").select("doc_id", "quality")
    return stats.split_profile(sampling.stratified_split(lab, "quality", ["doc_id"]), "split", "quality")


@register("stratified_folds", f"""
with r as ({_rank_sql(SQL_DOCS, "quality", "doc_id")})
select doc_id, quality, cast((rn - 1) % 5 as integer) as fold from r
""")
def q_stratified_folds(spark, sf_dir):
    """S-02: five stratified folds of the labelled documents."""
    d = inputs.docs_frame(spark, sf_dir).select("doc_id", "quality")
    return sampling.stratified_folds(d, "quality", ["doc_id"], 5, 42)



# --------------------------------------------------------------------------- NN-01/02
KNN_K = 5
SQL_EMB_LONG = """
  select vec_id, cast(unnest(embedding) as double) as x, unnest(generate_series(1, len(embedding))) as i
  from embeddings"""
_PAIR_EXPR = {
    "euclidean": "sqrt(sum((a.x - b.x) * (a.x - b.x)))",
    "manhattan": "sum(abs(a.x - b.x))",
    "chebyshev": "max(abs(a.x - b.x))",
    "minkowski": "pow(sum(pow(abs(a.x - b.x), 3.0)), 1.0 / 3.0)",
    "cosine": "1.0 - sum(a.x * b.x) / (sqrt(sum(a.x * a.x)) * sqrt(sum(b.x * b.x)))",
}


def _knn_sql(metric: str) -> str:
    return f"""
with e as ({SQL_EMB_LONG}),
d as (select a.vec_id as q, b.vec_id as r, {_PAIR_EXPR[metric]} as dist
      from e a join e b on a.i = b.i and a.vec_id <> b.vec_id group by a.vec_id, b.vec_id),
t as (select q, r, dist, row_number() over (partition by q order by dist, r) as rn from d)
select q as vec_id, r as neighbor_id, cast(rn as integer) as rank, round(dist, 6) as distance
from t where rn <= {KNN_K}"""


def _knn_query(metric: str):
    def run(spark, sf_dir):
        e = inputs.embedding_frame(spark, sf_dir)
        nb = neighbors.knn_join(e, e, KNN_K, inputs.EMBED_FEATURES, query_id="vec_id", ref_id="vec_id",
                                metric=metric, p=3.0, exclude_self=True)
        return nb.select("vec_id", "neighbor_id", "rank", "distance")
    run.__doc__ = f"NN-01/02: {KNN_K} nearest other embeddings of every embedding, {metric} distance."
    return run


for _m in ["euclidean", "manhattan", "chebyshev", "minkowski", "cosine"]:
    register(f"knn_join_{_m}", _knn_sql(_m))(_knn_query(_m))


# --------------------------------------------------------------------------- AG-11/12
@register("confusion_matrix", """
select count(*) filter (where quality <> 1 and toxic <> 1) as tn,
       count(*) filter (where quality <> 1 and toxic = 1) as fp,
       count(*) filter (where quality = 1 and toxic <> 1) as fn,
       count(*) filter (where quality = 1 and toxic = 1) as tp
from labels
""")
def q_confusion_matrix(spark, sf_dir):
    """AG-11: quality as the label, toxic as the prediction."""
    lab = inputs.table(spark, sf_dir, "labels")
    return metrics.confusion(lab, "quality", "toxic")


@register("classification_metrics", """
with c as (
  select count(*) filter (where quality <> 1 and toxic <> 1) as tn,
         count(*) filter (where quality <> 1 and toxic = 1) as fp,
         count(*) filter (where quality = 1 and toxic <> 1) as fn,
         count(*) filter (where quality = 1 and toxic = 1) as tp
  from labels)
select round(case when tn + fp + fn + tp = 0 then 0 else (tn + tp) * 1.0 / (tn + fp + fn + tp) end, 6) as accuracy,
       round(case when tp + fp = 0 then 0 else tp * 1.0 / (tp + fp) end, 6) as precision,
       round(case when tp + fn = 0 then 0 else tp * 1.0 / (tp + fn) end, 6) as recall,
       round(case when 2 * tp + fp + fn = 0 then 0 else 2.0 * tp / (2 * tp + fp + fn) end, 6) as f1,
       tn, fp, fn, tp
from c
""")
def q_classification_metrics(spark, sf_dir):
    """AG-12: accuracy, precision, recall, F1 of toxic as a predictor of quality."""
    lab = inputs.table(spark, sf_dir, "labels")
    return metrics.classification_metrics(lab, "quality", "toxic")



# --------------------------------------------------------------------------- KC-01/02/06/07/08, PL-02
PREDICT_K = 7
DOC_COLS = ["doc_id", "quality"] + inputs.DOC_FEATURES
_DF = inputs.DOC_FEATURES


def _doc_split(spark, sf_dir):
    d = inputs.docs_frame(spark, sf_dir).select(*DOC_COLS)
    s = steps.table(sampling.stratified_split(d, "quality", ["doc_id"], 0.2, 42), "split")
    return s.where("split = 'train'").drop("split"), s.where("split = 'test'").drop("split")


def _z(alias_src: str) -> str:
    return ", ".join(f"({alias_src}.{f} - p.m_{f}) / case when p.s_{f} = 0 then 1 else p.s_{f} end as {f}" for f in _DF)


def _dist(a: str, b: str) -> str:
    return "sqrt(" + " + ".join(f"({a}.{f} - {b}.{f}) * ({a}.{f} - {b}.{f})" for f in _DF) + ")"


SQL_DOC_BASE = f"""
s as ({_split_sql(SQL_DOCS, "quality", "doc_id", "doc_id, quality, " + ", ".join(_DF))}),
tr as (select * from s where split = 'train'),
te as (select * from s where split = 'test'),
p as (select {", ".join(f"avg({f}) as m_{f}, stddev_pop({f}) as s_{f}" for f in _DF)} from tr),
ztr as (select tr.doc_id, tr.quality, {_z("tr")} from tr cross join p),
zte as (select te.doc_id, te.quality, {_z("te")} from te cross join p),
fr as (select *, row_number() over (partition by quality
         order by md5(concat_ws('|', '42', cast(doc_id as varchar))), doc_id) as rn from ztr),
fo as (select *, (rn - 1) % 5 as fold from fr),
cvd as (select a.doc_id as q, a.fold, a.quality as lq, b.doc_id as r, b.quality as lr, {_dist("a", "b")} as dist
        from fo a join fo b on a.fold <> b.fold),
cvt as (select *, row_number() over (partition by q order by dist, r) as rk from cvd),
cum as (select q, fold, lq, rk as k,
               sum(case when lr = 1 then 1 else 0 end) over (partition by q order by rk rows unbounded preceding) as pos
        from cvt where rk <= 29),
votes as (select q, fold, lq, k, case when pos * 2 > k then 1 else 0 end as pred from cum where k % 2 = 1 and k >= 3),
ff as (select k, fold, count(*) filter (where lq <> 1 and pred = 1) as fp, count(*) filter (where lq = 1 and pred <> 1) as fn,
              count(*) filter (where lq = 1 and pred = 1) as tp from votes group by k, fold),
cv as (select k, avg(case when 2 * tp + fp + fn = 0 then 0 else 2.0 * tp / (2 * tp + fp + fn) end) as f1 from ff group by k),
kbest as (select coalesce((select k from cv where f1 > 0 order by round(f1, 12) desc, k limit 1), 5) as k),
pd as (select a.doc_id as q, b.doc_id as r, b.quality as lr, {_dist("a", "b")} as dist from zte a cross join ztr b),
pt as (select *, row_number() over (partition by q order by dist, r) as rk from pd)"""


def _vote_sql(k_expr: str) -> str:
    return f"""
nb as (select * from pt where rk <= {k_expr}),
agg as (select q, min(dist) as dmin,
               sum(case when lr = 0 and dist > 0 then 1.0 / dist end) as s0, sum(case when lr = 1 and dist > 0 then 1.0 / dist end) as s1,
               count(case when lr = 0 and dist = 0 then 1 end) as z0, count(case when lr = 1 and dist = 0 then 1 end) as z1
        from nb group by q),
w as (select q, case when dmin = 0 then z0 else coalesce(s0, 0) end as w0,
             case when dmin = 0 then z1 else coalesce(s1, 0) end as w1 from agg),
pr as (select q, case when w1 > w0 then 1 else 0 end as pred, w0 / (w0 + w1) as p0, w1 / (w0 + w1) as p1 from w)"""


@register("knn_predict", f"""
with {SQL_DOC_BASE}, {_vote_sql(str(PREDICT_K))}
select q as doc_id, pred as prediction, round(p1, 6) as probability from pr
""")
def q_knn_predict(spark, sf_dir):
    """KC-01/06/07 + NN-01/03: scaled 7-NN with inverse-distance vote, test split of the labelled documents."""
    train, test = _doc_split(spark, sf_dir)
    model = classify.fit(train, "quality", "doc_id", features=_DF, n_neighbors=PREDICT_K)
    v = classify.predict(model, test)
    return v.select("doc_id", "prediction", F.col(f"proba_{classify.positive_index(model)}").alias("probability"))


@register("knn_proba", f"""
with {SQL_DOC_BASE}, {_vote_sql(str(PREDICT_K))}
select q as doc_id, 0 as class, round(p0, 6) as probability from pr
union all
select q, 1, round(p1, 6) from pr
""")
def q_knn_proba(spark, sf_dir):
    """KC-07: class probabilities (weight shares) per test document, long form."""
    train, test = _doc_split(spark, sf_dir)
    model = classify.fit(train, "quality", "doc_id", features=_DF, n_neighbors=PREDICT_K)
    v = classify.predict(model, test)
    return v.select("doc_id", F.inline(F.array(*[
        F.struct(F.lit(c).cast("int").alias("class"), F.col(f"proba_{i}").alias("probability"))
        for i, c in enumerate(model.classes)])))


@register("knn_cv_scores", f"""
with {SQL_DOC_BASE}
select cast(k as integer) as k, round(f1, 6) as f1 from cv
""")
def q_knn_cv_scores(spark, sf_dir):
    """KC-02 + NN-04: 5-fold stratified CV F1 of a uniform vote for k = 3, 5, ..., 29."""
    train, _ = _doc_split(spark, sf_dir)
    model = classify.fit(train, "quality", "doc_id", features=_DF)
    return model.k_scores


@register("prediction_table", f"""
with {SQL_DOC_BASE}, {_vote_sql("(select k from kbest)")}
select te.doc_id, te.quality, {", ".join("te." + f for f in _DF)}, pr.pred as "Prediction", round(pr.p1, 6) as "Probability"
from te join pr on te.doc_id = pr.q
""")
def q_prediction_table(spark, sf_dir):
    """KC-08: test rows with Prediction and Probability, k chosen by CV."""
    train, test = _doc_split(spark, sf_dir)
    model = classify.fit(train, "quality", "doc_id", features=_DF)
    return classify.prediction_table(model, test)


@register("baseline_run", f"""
with {SQL_DOC_BASE}, {_vote_sql("(select k from kbest)")},
ev as (select te.quality as y, pr.pred as yh from te join pr on te.doc_id = pr.q),
c as (select count(*) filter (where y <> 1 and yh <> 1) as tn, count(*) filter (where y <> 1 and yh = 1) as fp,
             count(*) filter (where y = 1 and yh <> 1) as fn, count(*) filter (where y = 1 and yh = 1) as tp from ev)
select round(case when tn + fp + fn + tp = 0 then 0 else (tn + tp) * 1.0 / (tn + fp + fn + tp) end, 6) as accuracy,
       round(case when tp + fp = 0 then 0 else tp * 1.0 / (tp + fp) end, 6) as precision,
       round(case when tp + fn = 0 then 0 else tp * 1.0 / (tp + fn) end, 6) as recall,
       round(case when 2 * tp + fp + fn = 0 then 0 else 2.0 * tp / (2 * tp + fp + fn) end, 6) as f1,
       tn, fp, fn, tp, cast((select k from kbest) as integer) as n_neighbors, true as auto_k
from c
""")
def q_baseline_run(spark, sf_dir):
    """PL-02: split → scale → CV-chosen k → weighted kNN → test metrics, no imputation."""
    from .workflow import run
    d = inputs.docs_frame(spark, sf_dir).select(*DOC_COLS)
    return run(d, "quality", "doc_id", imputer=None)["metrics"]



# --------------------------------------------------------------------------- CL-04, AG-06, CL-05
SQL_EMB_CENTRES = f"""
e as ({SQL_EMB_LONG}),
lab as (select vec_id, label from embeddings),
ctr as (select l.label as c, e.i, avg(e.x) as y from e join lab l using (vec_id) group by l.label, e.i),
dd as (select e.vec_id, ctr.c, sqrt(sum((e.x - ctr.y) * (e.x - ctr.y))) as dist
       from e join ctr on e.i = ctr.i group by e.vec_id, ctr.c),
asg as (select vec_id, c as cluster, dist from
          (select *, row_number() over (partition by vec_id order by dist, c) as rn from dd) where rn = 1)"""


def _label_centres(spark, sf_dir):
    e = inputs.embedding_frame(spark, sf_dir)
    rows = e.groupBy("label").agg(*[F.avg(f).alias(f) for f in inputs.EMBED_FEATURES]).orderBy("label").collect()
    ids = [r["label"] for r in rows]
    return e, ids, {None: [[r[f] for f in inputs.EMBED_FEATURES] for r in rows]}


@register("cluster_assign", f"""
with {SQL_EMB_CENTRES}
select vec_id, cast(cluster as integer) as cluster, round(dist, 6) as distance from asg
""")
def q_cluster_assign(spark, sf_dir):
    """CL-04: each embedding to the nearest of the per-label mean vectors (Euclidean)."""
    e, ids, centres = _label_centres(spark, sf_dir)
    a = clustering.assign_nearest(e, inputs.EMBED_FEATURES, centres, out="_ci", dist_out="distance")
    ids_arr = F.array(*[F.lit(i) for i in ids])
    return a.select("vec_id", ids_arr[F.col("_ci")].cast("int").alias("cluster"), "distance")


@register("cluster_sizes", f"""
with {SQL_EMB_CENTRES}
select cast(c.label as integer) as cluster, count(a.vec_id) as count
from (select distinct label from embeddings) c left join asg a on a.cluster = c.label group by c.label
""")
def q_cluster_sizes(spark, sf_dir):
    """AG-06: rows per nearest-centre cluster, empty clusters included as 0."""
    e, ids, centres = _label_centres(spark, sf_dir)
    a = clustering.assign_nearest(e, inputs.EMBED_FEATURES, centres, out="_ci")
    grid = spark.createDataFrame([(i, int(x)) for i, x in enumerate(ids)], "_ci int, cluster int")
    cnt = a.groupBy("_ci").agg(F.count(F.lit(1)).alias("count"))
    return grid.join(cnt, "_ci", "left").select("cluster", F.coalesce("count", F.lit(0)).alias("count"))


@register("silhouette", f"""
with e as ({SQL_EMB_LONG}),
lab as (select vec_id, label from embeddings),
pts as (select e.vec_id, l.label, e.i, e.x from e join lab l using (vec_id)),
nrm as (select vec_id, label, sum(x * x) as sq from pts group by vec_id, label),
cs as (select label as c, count(*) as n, sum(sq) as psi from nrm group by label),
cy as (select label as c, i, sum(x) as y from pts group by label, i),
dots as (select p.vec_id, cy.c, sum(p.x * cy.y) as dot from pts p join cy on p.i = cy.i group by p.vec_id, cy.c),
dist as (select d.vec_id, n2.label as own, d.c, cs.n, n2.sq + cs.psi / cs.n - 2 * d.dot / cs.n as dd
         from dots d join cs on d.c = cs.c join nrm n2 on n2.vec_id = d.vec_id),
ab as (select vec_id, max(case when c = own then dd * n / (n - 1) end) as a, min(case when c <> own then dd end) as b,
              max(case when c = own then n end) as n_own from dist group by vec_id),
s as (select case when n_own <= 1 or b is null then 0.0 when a < b then 1 - a / b when a > b then b / a - 1 else 0.0 end as s
      from ab)
select round(avg(s), 6) as silhouette from s
""")
def q_silhouette(spark, sf_dir):
    """CL-05: squared-Euclidean silhouette of the embedding labels (linear time)."""
    e = inputs.embedding_frame(spark, sf_dir)
    return clustering.silhouette(e, inputs.EMBED_FEATURES, "label")


# --------------------------------------------------------------------------- AG-07, IM-02/03 with fixed centres
ORDER_IMPUTE = ["price"]
_OF = ORDER_FEATURES


def _order_centres(spark, sf_dir):
    """Orders filled with class medians, scaled per class; centres = per
    (status, priority) means of the scaled rows (priority rank = cluster id)."""
    o = inputs.orders_frame(spark, sf_dir)
    gm = stats.global_medians(o, ORDER_IMPUTE)
    cm = stats.class_medians(o, "o_orderstatus", ORDER_IMPUTE, fallback=gm)
    filled = stats.median_fill(o, ORDER_IMPUTE, cm, ["o_orderstatus"], global_fallback=gm, out_suffix="__t")
    filled = filled.withColumns({f + "__t": F.col(f) for f in _OF if f not in ORDER_IMPUTE})
    sc = scaling.fit_scaler(filled.select("o_orderstatus", *[F.col(f + "__t").alias(f) for f in _OF]),
                            _OF, ["o_orderstatus"])
    z = steps.table(scaling.apply_scaler(filled, _OF, sc, ["o_orderstatus"], suffix="__z", src_suffix="__t"), "scaled")
    rows = (z.groupBy("o_orderstatus", "o_orderpriority").agg(*[F.avg(f + "__z").alias(f) for f in _OF])
            .orderBy("o_orderstatus", "o_orderpriority").collect())
    centres: dict = {}
    for r in rows:
        centres.setdefault(r["o_orderstatus"], []).append([r[f] for f in _OF])
    assigned = clustering.assign_nearest(z, [f + "__z" for f in _OF], centres, "o_orderstatus")
    return o, gm, cm, assigned


SQL_ORDER_CLUSTERS = f"""
src as ({SQL_ORDERS}),
g as (select median(price) filter (where price <> 0) as gm from src),
cm as (select o_orderstatus, coalesce(median(price) filter (where price <> 0), (select gm from g)) as cmed
       from src group by o_orderstatus),
fl as (select src.*, case when price = 0 then cm.cmed else price end as price_t from src join cm using (o_orderstatus)),
sp as (select o_orderstatus, avg(price_t) as m_p, stddev_pop(price_t) as s_p, avg(custkey) as m_c, stddev_pop(custkey) as s_c,
              avg(days) as m_d, stddev_pop(days) as s_d from fl group by o_orderstatus),
z as (select fl.o_orderkey, fl.o_orderstatus, fl.o_orderpriority, fl.price,
             (price_t - m_p) / case when s_p = 0 then 1 else s_p end as zp,
             (custkey - m_c) / case when s_c = 0 then 1 else s_c end as zc,
             (days - m_d) / case when s_d = 0 then 1 else s_d end as zd
      from fl join sp using (o_orderstatus)),
ctr as (select o_orderstatus, o_orderpriority, avg(zp) as cp, avg(zc) as cc, avg(zd) as cd,
               row_number() over (partition by o_orderstatus order by o_orderpriority) - 1 as cluster
        from z group by o_orderstatus, o_orderpriority),
dd as (select z.*, ctr.cluster, sqrt((zp - cp) * (zp - cp) + (zc - cc) * (zc - cc) + (zd - cd) * (zd - cd)) as dist
       from z join ctr using (o_orderstatus)),
asg as (select * from (select *, row_number() over (partition by o_orderkey order by dist, cluster) as rn from dd) where rn = 1),
cmed as (select c.o_orderstatus, c.cluster,
                coalesce(median(a.price) filter (where a.price <> 0), min(cm.cmed)) as median
         from ctr c left join asg a on a.o_orderstatus = c.o_orderstatus and a.cluster = c.cluster
         join cm on cm.o_orderstatus = c.o_orderstatus
         group by c.o_orderstatus, c.cluster)"""


@register("cluster_medians", f"""
with {SQL_ORDER_CLUSTERS}
select o_orderstatus, cast(cluster as integer) as cluster, 'price' as "column", round(median, 6) as median from cmed
""")
def q_cluster_medians(spark, sf_dir):
    """AG-07: median of real prices per (status, cluster), falling back to the status median."""
    o, gm, cm, assigned = _order_centres(spark, sf_dir)
    return impute_kmeans.cluster_medians(assigned, "o_orderstatus", "cluster", ORDER_IMPUTE, cm)


@register("cluster_impute", f"""
with {SQL_ORDER_CLUSTERS}
select a.o_orderkey, round(case when a.price = 0 then coalesce(m.median, (select gm from g)) else a.price end, 6) as price
from asg a left join cmed m on m.o_orderstatus = a.o_orderstatus and m.cluster = a.cluster
""")
def q_cluster_impute(spark, sf_dir):
    """IM-02/03: zero prices take the median of their (status, cluster)."""
    o, gm, cm, assigned = _order_centres(spark, sf_dir)
    med = impute_kmeans.cluster_medians(assigned, "o_orderstatus", "cluster", ORDER_IMPUTE, cm)
    out = impute_kmeans.fill_from_clusters(assigned, ORDER_IMPUTE, med, "o_orderstatus", "cluster", gm)
    return out.select("o_orderkey", "price")



# --------------------------------------------------------------------------- IM-08..13
CUST_IMPUTE = ["acctbal", "nation"]


def _knn_impute_ctes(k: int, weights: str, fit: str, data: str, cls: str, key: str, feats: list[str], cols: list[str], p: str = "") -> tuple[list[str], str]:
    """CTEs of the neighbour imputer fitted on table ``fit`` and applied to ``data`` (names end in ``p``), and the last one's name."""
    z = lambda e, f: f"(({e}) - sc{p}.m_{f}) / case when sc{p}.s_{f} = 0 then 1 else sc{p}.s_{f} end"
    ctes = [
        f"gm{p} as (select " + ", ".join(f"median({c}) filter (where {c} <> 0) as g_{c}" for c in cols) + f" from {fit})",
        f"cmed{p} as (select {cls}, " + ", ".join(f"median({c}) filter (where {c} <> 0) as c_{c}" for c in cols)
        + f" from {fit} group by {cls})",
        f"fil{p} as (select s.{cls}, " + ", ".join(
            f"case when s.{c} = 0 then coalesce(c.c_{c}, g.g_{c}, 0) else s.{c} end as {c}" for c in cols)
        + "".join(f", s.{f}" for f in feats if f not in cols)
        + f" from {fit} s join cmed{p} c using ({cls}) cross join gm{p} g)",
        f"sc{p} as (select {cls}, " + ", ".join(f"avg({f}) as m_{f}, stddev_pop({f}) as s_{f}" for f in feats)
        + f" from fil{p} group by {cls})",
        f"cn{p} as (select {cls}, count(*) as n from {data} group by {cls})",
        f"d{p}1 as (select s.{key}, s.{cls}, cn{p}.n, " + ", ".join(
            (f"case when cn{p}.n < {k} and s.{f} = 0 then gm.g_{f} else s.{f} end as {f}" if f in cols else f"s.{f}")
            for f in feats) + f" from {data} s join cn{p} using ({cls}) cross join gm{p} gm)",
    ]
    prev = f"d{p}1"
    for i, col in enumerate(cols):
        others = [f for f in feats if f != col]
        qv = lambda f: f"case when d.{f} = 0 then gm.g_{f} else d.{f} end" if f in cols else f"d.{f}"
        ctes.append(f"don{p}{i} as (select d.{key} as r, d.{cls} as g, d.{col} as v, "
                    + ", ".join(f"{z('d.' + f, f)} as {f}" for f in others)
                    + f" from {prev} d join sc{p} using ({cls}) where d.n >= {k} and d.{col} <> 0)")
        ctes.append(f"qry{p}{i} as (select d.{key} as q, d.{cls} as g, "
                    + ", ".join(f"{z(qv(f), f)} as {f}" for f in others)
                    + f" from {prev} d join sc{p} using ({cls}) cross join gm{p} gm where d.n >= {k} and d.{col} = 0)")
        ctes.append(f"dn{p}{i} as (select g, count(*) as dn from don{p}{i} group by g)")
        dist = "sqrt(" + " + ".join(f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in others) + ")"
        ctes.append(f"pr{p}{i} as (select a.q, b.r, b.v, {dist} as dist from qry{p}{i} a join don{p}{i} b on a.g = b.g)")
        ctes.append(f"rk{p}{i} as (select * from (select *, row_number() over (partition by q order by dist, r) as rn "
                    f"from pr{p}{i}) where rn <= {k})")
        agg = ("sum((1.0 / (dist + 1e-10)) * v) / sum(1.0 / (dist + 1e-10))" if weights == "distance"
               else "median(v)")
        ctes.append(f"fv{p}{i} as (select q, {agg} as fill from rk{p}{i} group by q)")
        sel = []
        for f in feats:
            if f == col:
                sel.append(f"case when d.n >= {k} and d.{col} = 0 then (case when coalesce(dn.dn, 0) >= {k} "
                           f"and fv.fill is not null then fv.fill else gm.g_{col} end) else d.{col} end as {col}")
            else:
                sel.append(f"d.{f}")
        ctes.append(f"d{p}{i + 2} as (select d.{key}, d.{cls}, d.n, {', '.join(sel)} from {prev} d "
                    f"left join fv{p}{i} fv on fv.q = d.{key} left join dn{p}{i} dn on dn.g = d.{cls} "
                    f"cross join gm{p} gm)")
        prev = f"d{p}{i + 2}"
    return ctes, prev


def _knn_impute_sql(k: int, weights: str) -> str:
    ctes, last = _knn_impute_ctes(k, weights, "src", "src", "c_mktsegment", "c_custkey", CUST_FEATURES, CUST_IMPUTE)
    return ("with " + ",\n".join([f"src as ({SQL_CUSTOMER})", *ctes]) + f"\nselect c_custkey, c_mktsegment, "
            + ", ".join(f"round({f}, 6) as {f}" for f in CUST_FEATURES) + f" from {last}")


def _knn_impute_query(k: int, weights: str, doc: str):
    def run(spark, sf_dir):
        c = inputs.customer_frame(spark, sf_dir)
        model = impute_knn.fit(c, "c_mktsegment", "c_custkey", CUST_IMPUTE, n_neighbors=k, weights=weights)
        return impute_knn.transform(model, c)
    run.__doc__ = doc
    return run


register("knn_impute_weighted", _knn_impute_sql(5, "distance"))(_knn_impute_query(
    5, "distance", "IM-08..11: balance then nation zeros filled, per segment, by the inverse-distance "
                   "mean of the 5 nearest donors."))
register("knn_impute_median", _knn_impute_sql(5, "uniform"))(_knn_impute_query(
    5, "uniform", "IM-12: the same fill with the median of the 5 nearest donors."))
register("knn_impute_fallback", _knn_impute_sql(290, "distance"))(_knn_impute_query(
    290, "distance", "IM-13: 290 neighbours — segments with fewer rows or donors fall back to global medians."))


@register("knn_imputer_summary", f"""
with src as ({SQL_CUSTOMER}),
m as (select 'acctbal' as "column", median(acctbal) filter (where acctbal <> 0) as median from src
      union all select 'nation', median(nation) filter (where nation <> 0) from src)
select 5 as n_neighbors, true as class_aware, 'distance' as weights, 42 as random_state, "column", round(median, 6) as median,
       (select cast(count(distinct c_mktsegment) as integer) from src) as n_classes
from m
""")
def q_knn_imputer_summary(spark, sf_dir):
    """AG-10: parameters and global medians of a fitted neighbour imputer, a row per column."""
    c = inputs.customer_frame(spark, sf_dir)
    found = impute_knn.summary(impute_knn.fit(c, "c_mktsegment", "c_custkey", CUST_IMPUTE))
    return found.select("n_neighbors", "class_aware", "weights", "random_state",
                        F.explode("global_medians").alias("column", "median"), "n_classes")


@register("knn_impute_job", _knn_impute_sql(5, "distance"))
def q_knn_impute_job(spark, sf_dir):
    """IM-14 / IM-05: read a table, fit and transform with the neighbour imputer, write the result, read it back."""
    source, target = _shared(spark, "customers"), _shared(spark, "imputed")
    inputs.customer_frame(spark, sf_dir).write.parquet(source)
    impute_knn.impute_dataset_knn(spark, source, target, "c_mktsegment", "c_custkey", CUST_IMPUTE)
    return read_table(spark, target, inputs.customer_frame(spark, sf_dir).schema, "csv")


@register("csv_round_trip", f"""
with src as ({SQL_CUSTOMER}),
s as ({_split_sql("select * from src", "c_mktsegment", "c_custkey", "c_custkey, c_mktsegment, acctbal, nation, custno")})
select c_custkey, c_mktsegment, round(acctbal, 6) as acctbal, round(nation, 6) as nation, round(custno, 6) as custno, split from s
""")
def q_csv_round_trip(spark, sf_dir):
    """IO-01..03: train and test split written as CSV folders and loaded again, format found from the files."""
    c = inputs.customer_frame(spark, sf_dir)
    s = sampling.stratified_split(c, "c_mktsegment", ["c_custkey"], 0.2, 42)
    paths = {name: write_table(s.where(F.col("split") == name).drop("split"), _shared(spark, name)) for name in ("train", "test")}
    train, test = load_splits(spark, paths["train"], paths["test"], c.schema)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@register("csv_malformed_rows", """
with l as (
  select c_custkey, cast(c_custkey as varchar) || ',' || c_mktsegment || ',' || cast(c_nationkey as varchar) as line,
         c_mktsegment, c_nationkey from customer)
select case when c_custkey % 50 <> 0 and c_custkey % 77 <> 0 then c_custkey end as c_custkey,
       case when c_custkey % 50 <> 0 and c_custkey % 77 <> 0 then c_mktsegment end as c_mktsegment,
       case when c_custkey % 50 <> 0 and c_custkey % 77 <> 0 then c_nationkey end as c_nationkey,
       case when c_custkey % 50 = 0 then 'k' || line when c_custkey % 77 = 0 then line || ',9' end as malformed,
       (select count(*) from l where c_custkey % 50 = 0 or c_custkey % 77 = 0) as n_malformed
from l
""")
def q_csv_malformed_rows(spark, sf_dir):
    """IO-01: customers written as CSV lines, some with a key that is no number or a field too many; good rows, the texts of
    the others, and their count as observed on the way."""
    c, path = inputs.table(spark, sf_dir, "customer"), _shared(spark, "lines")
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_mktsegment", F.col("c_nationkey").cast("string"))
    line = F.when(F.col("c_custkey") % 50 == 0, F.concat(F.lit("k"), line)).when(
        F.col("c_custkey") % 77 == 0, F.concat(line, F.lit(",9"))).otherwise(line)
    c.select(line.alias("custkey,segment,nation")).write.option("header", True).option("quote", "").option("sep", "\x01").csv(path)
    good, bad, counts = read_checked(spark, path, "c_custkey long, c_mktsegment string, c_nationkey long")
    good = steps.table(good, "good")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in good.schema]
    return good.withColumn("malformed", F.lit(None).cast("string")).unionByName(
        bad.select(*nothing, F.col("_malformed").alias("malformed"))).withColumn("n_malformed", F.lit(counts.get["malformed"]).cast("long"))


# --------------------------------------------------------------------------- CL-01..03/06, IM-01..05, AG-08/09, PL-01
ORDER_COLS = ["o_orderkey", "o_orderstatus"] + ORDER_FEATURES


def _orders_model(spark, sf_dir, **kw):
    o = steps.table(inputs.orders_frame(spark, sf_dir).select(*ORDER_COLS), "orders")
    return o, impute_kmeans.fit(o, "o_orderstatus", "o_orderkey", ORDER_IMPUTE, **kw)


def _checked_fill(o: DataFrame, imputed: DataFrame, model) -> DataFrame:
    """Per order: the real price (null where it was missing), and whether a fill is a median of its class's clusters."""
    per = model.medians.where(F.col("column") == "price")
    ok = per.groupBy("o_orderstatus").agg(F.collect_set("median").alias("medians")) if model.class_aware else \
        per.agg(F.collect_set("median").alias("medians"))
    new = imputed.select("o_orderkey", "o_orderstatus", F.col("price").alias("new"))
    both = o.select("o_orderkey", "price").join(new, "o_orderkey")
    both = both.join(ok, "o_orderstatus") if model.class_aware else both.join(ok)  # one row of medians
    filled = F.col("price") == 0
    return both.select("o_orderkey", "o_orderstatus", F.when(~filled, F.col("new")).alias("price"),
                       F.when(filled, F.array_contains("medians", F.col("new"))).otherwise(F.col("new") == F.col("price")).alias("ok"))


_CHECKED_FILL_SQL = f"""
select o_orderkey, o_orderstatus, round(case when price <> 0 then price end, 6) as price, true as ok from ({SQL_ORDERS})
"""


@register("kmeans_impute", _CHECKED_FILL_SQL)
def q_kmeans_impute(spark, sf_dir):
    """IM-01/02/05: class-aware k-means imputation of the zero prices of all orders (k by silhouette over 2..8 per
    status); real prices as they come back, and whether each fill is a cluster median of its status."""
    o, model = _orders_model(spark, sf_dir)
    return _checked_fill(o, impute_kmeans.transform(model, o), model)


@register("kmeans_impute_global", _CHECKED_FILL_SQL)
def q_kmeans_impute_global(spark, sf_dir):
    """CL-03 / IM-04: the same with one global k-means model (class_aware=False) of 4 clusters."""
    o, model = _orders_model(spark, sf_dir, class_aware=False, n_clusters=4)
    return _checked_fill(o, impute_kmeans.transform(model, o), model)


@register("cluster_search", f"""
with src as ({SQL_ORDERS})
select o_orderstatus, cast(k as integer) as k, true as valid, 1 as n_chosen
from (select distinct o_orderstatus from src), range(2, 9) t(k)
""")
def q_cluster_search(spark, sf_dir):
    """CL-06 + AG-08: every status and k is searched; its silhouette, cost and iterations are in range, one k is
    chosen, and it is the one of highest silhouette."""
    o, model = _orders_model(spark, sf_dir)
    rows = []
    for c, k, s, cost, n in model.search.scores:
        top = max(x[2] for x in model.search.scores if x[0] == c)
        chosen = [x[1] for x in model.search.scores if x[0] == c and x[1] == model.k[c] and x[2] == top]
        rows.append((str(c), int(k), bool(-1 <= s <= 1 and cost > 0 and 0 < n <= 300), len(chosen)))
    return spark.createDataFrame(rows, "o_orderstatus string, k int, valid boolean, n_chosen int")


@register("cluster_summary", f"""
with src as ({SQL_ORDERS})
select o_orderstatus, count(*) as rows, count(*) as clustered, true as valid, count(*) as per_cluster
from src group by o_orderstatus
""")
def q_cluster_summary(spark, sf_dir):
    """AG-06/08/09: per status its rows, the rows in its clusters, clusters times rows per cluster, and whether
    k, inertia, silhouette and iterations are in range."""
    o, model = _orders_model(spark, sf_dir)
    per = impute_kmeans.class_summary(model).withColumnRenamed("class", "o_orderstatus")
    cpc = impute_kmeans.clusters_per_class(model, o).withColumnRenamed("class", "o_orderstatus")
    sizes = model.sizes.groupBy("o_orderstatus").agg(F.sum("count").alias("clustered"), F.count(F.lit(1)).alias("k"))
    whole = impute_kmeans.summary(model).first()
    valid = (F.col("n_clusters").between(2, 8) & (F.col("n_clusters") == F.col("k")) & (F.col("inertia") > 0)
             & F.col("silhouette").between(-1, 1) & F.col("n_iterations").between(1, whole["n_iterations"])
             & F.lit(whole["n_clusters"] == f"{len(model.k)} classes"))
    return per.join(cpc.drop("clusters"), "o_orderstatus").join(sizes, "o_orderstatus").select(
        "o_orderstatus", "rows", "clustered", valid.alias("valid"),
        F.round(F.col("rows_per_cluster") * F.col("n_clusters")).cast("long").alias("per_cluster"))


@register("full_run", f"""
with src as (select o_orderkey, case when o_orderstatus = 'F' then 1 else 0 end as is_f, price from ({SQL_ORDERS})),
s as ({_split_sql("select * from src", "is_f", "o_orderkey", "o_orderkey, is_f")})
select count(*) as n_test, cast(sum(is_f) as bigint) as n_positive, true as k_valid, true as scores_valid, 0 as missing
from s where split = 'test'
""")
def q_full_run(spark, sf_dir):
    """PL-01/03: split, class-aware k-means imputation of price, CV-chosen weighted kNN predicting order status 'F';
    rows and positives scored, whether k and the scores fit the confusion matrix, and prices left missing."""
    o = inputs.orders_frame(spark, sf_dir).select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("is_f"), *ORDER_FEATURES)
    from .workflow import run
    out = run(o, "is_f", "o_orderkey", imputer="kmeans", impute_cols=ORDER_IMPUTE)
    m = out["metrics"].first()
    ratio = lambda a, b: a / b if b else 0.0
    scores = {"accuracy": ratio(m.tn + m.tp, m.tn + m.fp + m.fn + m.tp), "precision": ratio(m.tp, m.tp + m.fp),
              "recall": ratio(m.tp, m.tp + m.fn), "f1": ratio(2 * m.tp, 2 * m.tp + m.fp + m.fn)}
    left = out["train_imputed"].unionByName(out["test_imputed"]).where("price = 0 or price is null").count()
    row = (m.tn + m.fp + m.fn + m.tp, m.fn + m.tp, m.n_neighbors in range(3, 31, 2),
           all(abs(m[k] - v) < 1e-9 for k, v in scores.items()), left)
    return spark.createDataFrame([row], "n_test long, n_positive long, k_valid boolean, scores_valid boolean, missing int")


# --------------------------------------------------------------------------- KC-06/07, AG-13
@register("predict_null_features", f"""
with {SQL_DOC_BASE}, {_vote_sql(str(PREDICT_K))}
select q as doc_id, case when q % 11 <> 0 then pred end as prediction,
       round(case when q % 11 <> 0 then p1 end, 6) as probability from pr
""")
def q_predict_null_features(spark, sf_dir):
    """KC-06/07: every row is returned; rows that lack a feature (here the line count of every 11th id) have no prediction."""
    train, test = _doc_split(spark, sf_dir)
    model = classify.fit(train, "quality", "doc_id", features=_DF, n_neighbors=PREDICT_K)
    test = test.withColumn("n_lines", F.when(F.col("doc_id") % 11 != 0, F.col("n_lines")))
    v = classify.predict(model, test)
    return v.select("doc_id", "prediction", F.col(f"proba_{classify.positive_index(model)}").alias("probability"))


@register("classifier_summary", f"""
with {SQL_DOC_BASE}
select cast((select k from kbest) as integer) as n_neighbors, true as auto_k, 'euclidean' as metric, {len(_DF)} as n_features_selected,
       round(f1, 6) as best_k_score, cast((select count(*) from cv) as integer) as n_scores
from cv where k = (select k from kbest)
""")
def q_classifier_summary(spark, sf_dir):
    """AG-13: the fitted classifier's settings, number of features, candidate ks and F1 of the chosen one."""
    train, _ = _doc_split(spark, sf_dir)
    found = classify.summary(classify.fit(train, "quality", "doc_id", features=_DF))
    return found.select("n_neighbors", "auto_k", "metric", "n_features_selected", "best_k_score",
                        F.size("k_scores").alias("n_scores"))


# --------------------------------------------------------------------------- NN-01/03, KC-06..08, IM-09: repeated and NULL keys
#: Customer numbers lie on a grid, where donors tie in pairs and rounding decides; their roots do not.
SQL_CUSTOMER_ROOTS = f"select c_custkey, c_mktsegment, acctbal, nation, sqrt(custno) as custno from ({SQL_CUSTOMER})"


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.customer_frame(spark, sf_dir).withColumn("custno", F.sqrt("custno"))


_TWICE = """
tw as (select row_number() over (order by c_custkey, copy) as uid,
              case when c_custkey % 5 <> 0 then c_custkey % 40 end as c_custkey, c_mktsegment, acctbal, nation, custno
       from src, (values (1), (2)) t(copy) where {where})"""


def _twice(c: DataFrame) -> DataFrame:
    """Customers twice, with keys that repeat, every fifth NULL."""
    both = c.unionByName(c)
    return both.withColumn("c_custkey", F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey") % 40))


def _scaled_sql(tr: str, te: str, feats: list[str]) -> str:
    """CTEs ``zt`` and ``zq``: both tables scaled by the statistics of ``tr``, features as s_<name>."""
    z = ", ".join(f"({f} - p.m_{f}) / case when p.s_{f} = 0 then 1 else p.s_{f} end as s_{f}" for f in feats)
    return (f"p as (select {', '.join(f'avg({f}) as m_{f}, stddev_pop({f}) as s_{f}' for f in feats)} from {tr}),\n"
            f"zt as (select t.*, {z} from {tr} t cross join p),\nzq as (select t.*, {z} from {te} t cross join p)")


def _shares_sql(q: str, r: str, label: str, feats: list[str], k: str) -> str:
    """CTE ``sh``: (q, lr, w, share, n) of the inverse-distance votes of ``zq`` rows among ``zt`` rows; n = 1 is the winner."""
    dist = "sqrt(" + " + ".join(f"(a.s_{f} - b.s_{f}) * (a.s_{f} - b.s_{f})" for f in feats) + ")"
    return f"""
pt as (select *, row_number() over (partition by q order by dist, r) as rk
       from (select a.{q} as q, b.{r} as r, b.{label} as lr, {dist} as dist from zq a cross join zt b)),
nb as (select *, min(dist) over (partition by q) as dmin from pt where rk <= {k}),
wt as (select q, lr, case when min(dmin) = 0 then cast(count(*) filter (dist = 0) as double) else sum(1.0 / dist) end as w
       from nb group by q, lr),
sh as (select *, w / sum(w) over (partition by q) as share, row_number() over (partition by q order by w desc, lr) as n from wt where w > 0)"""


@register("predict_repeated_keys", f"""
with src as ({SQL_CUSTOMER_ROOTS}),
tr as (select *, cast(c_mktsegment = 'BUILDING' as integer) as y from src where c_custkey % 2 = 0),
{_TWICE.format(where="c_custkey % 2 = 1")},
{_scaled_sql("tr", "tw", CUST_FEATURES)}, {_shares_sql("uid", "c_custkey", "y", CUST_FEATURES, "7")}
select tw.c_custkey, tw.custno, sh.lr as prediction, round(coalesce((select share from sh o where o.q = tw.uid and o.lr = 1), 0), 6) as probability
from tw join sh on sh.q = tw.uid and sh.n = 1
""")
def q_predict_repeated_keys(spark, sf_dir):
    """NN-01/03, KC-06..08: customers given twice under repeated and NULL keys, each row predicted by its own neighbours."""
    c = _customers(spark, sf_dir).withColumn("y", (F.col("c_mktsegment") == "BUILDING").cast("int"))
    model = classify.fit(c.where("c_custkey % 2 = 0"), "y", "c_custkey", features=CUST_FEATURES, n_neighbors=7)
    out = classify.prediction_table(model, _twice(c.where("c_custkey % 2 = 1")))
    return out.select("c_custkey", "custno", F.col("Prediction").alias("prediction"), F.col("Probability").alias("probability"))


def _impute_repeated_sql() -> str:
    ctes, last = _knn_impute_ctes(5, "distance", "tw", "tw", "c_mktsegment", "uid", CUST_FEATURES, CUST_IMPUTE)
    return ("with " + ",\n".join([f"src as ({SQL_CUSTOMER_ROOTS})", _TWICE.format(where="true"), *ctes])
            + f"\nselect tw.c_custkey, d.c_mktsegment, {', '.join(f'round(d.{f}, 6) as {f}' for f in CUST_FEATURES)} "
            + f"from {last} d join tw using (uid)")


@register("knn_impute_repeated_keys", _impute_repeated_sql())
def q_knn_impute_repeated_keys(spark, sf_dir):
    """IM-09..11: customers given twice under repeated and NULL keys; every row comes back with its own fills."""
    c = _twice(_customers(spark, sf_dir))
    return impute_knn.fit_transform(c, "c_mktsegment", "c_custkey", CUST_IMPUTE)


# --------------------------------------------------------------------------- PF-07, S-01/02, NN-03, KC-06/07: very many classes
@register("split_many_classes", f"""
with s as ({_split_sql("select l_orderkey * 10 + l_linenumber as line, l_partkey from lineitem", "l_partkey", "line", "line, l_partkey")})
select l_partkey, count(*) as rows, count(*) filter (split = 'train') as train, cast(sum(case when split = 'test' then line else 0 end) as bigint) as test_lines
from s group by l_partkey
""")
def q_split_many_classes(spark, sf_dir):
    """S-01 over thousands of classes (parts): exact quotas, and which lines are in each class's test part."""
    lines = inputs.table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"), "l_partkey")
    s = sampling.stratified_split(lines, "l_partkey", ["line"], 0.2, 42)
    test = F.col("split") == "test"
    return s.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(~test, 1)).alias("train"),
                                      F.sum(F.when(test, F.col("line")).otherwise(0)).alias("test_lines"))


_MANY = ["price", "custkey", "days"]
_MANY_SQL = f"""
with src as (select *, cast(cast(custkey as bigint) % 400 as varchar) || o_orderpriority as cls from ({SQL_ORDERS})),
tr as (select * from src where o_orderkey % 8 <> 0), te as (select * from src where o_orderkey % 8 = 0),
{_scaled_sql("tr", "te", _MANY)}, {_shares_sql("o_orderkey", "o_orderkey", "cls", _MANY, "5")}"""


def _many_classes(spark, sf_dir):
    o = inputs.orders_frame(spark, sf_dir).withColumn(
        "cls", F.concat((F.col("custkey").cast("long") % 400).cast("string"), "o_orderpriority"))
    return classify.fit(o.where("o_orderkey % 8 <> 0"), "cls", "o_orderkey", features=_MANY, n_neighbors=5), o.where("o_orderkey % 8 = 0")


@register("vote_many_classes", _MANY_SQL + """
select q as o_orderkey, lr as prediction, round(share, 6) as probability from sh where n = 1
""")
def q_vote_many_classes(spark, sf_dir):
    """NN-03 + KC-06 over some 2,000 classes: the class of largest weight of every eighth order, and its share."""
    model, test = _many_classes(spark, sf_dir)
    return classify.predict(model, test)


@register("proba_many_classes", _MANY_SQL + """
select q as o_orderkey, lr as class, round(share, 6) as probability from sh
""")
def q_proba_many_classes(spark, sf_dir):
    """KC-07 over some 2,000 classes: every class with a share of a row's vote."""
    model, test = _many_classes(spark, sf_dir)
    return classify.predict_proba(model, test).select("o_orderkey", "class", "probability")


# --------------------------------------------------------------------------- PL-03: the whole run with the neighbour imputer
def _run_sql(ctes: list[str], tr: str, te: str, key: str, label: str, feats: list[str]) -> str:
    """CTEs of a run from imputed train and test tables: scaling, k by cross-validation (``kbest``), votes (``sh``)."""
    dist = "sqrt(" + " + ".join(f"(a.s_{f} - b.s_{f}) * (a.s_{f} - b.s_{f})" for f in feats) + ")"
    return "with " + ",\n".join([
        *ctes, _scaled_sql(tr, te, feats),
        f"fo as (select *, (row_number() over (partition by {label} order by md5(concat_ws('|', '42', cast({key} as varchar))), {key}) - 1) % 5 "
        "as fold from zt)",
        f"""cvt as (select *, row_number() over (partition by q order by dist, r) as rk from (
    select a.{key} as q, a.fold, a.{label} as lq, b.{key} as r, b.{label} as lr, {dist} as dist from fo a join fo b on a.fold <> b.fold))""",
        """cum as (select q, fold, lq, rk as k, sum(lr) over (partition by q order by rk rows unbounded preceding) as pos from cvt where rk <= 29),
votes as (select q, fold, lq, k, case when pos * 2 > k then 1 else 0 end as pred from cum where k % 2 = 1 and k >= 3),
ff as (select k, fold, count(*) filter (where lq <> 1 and pred = 1) as fp, count(*) filter (where lq = 1 and pred <> 1) as fn,
              count(*) filter (where lq = 1 and pred = 1) as tp from votes group by k, fold),
cv as (select k, avg(case when 2 * tp + fp + fn = 0 then 0 else 2.0 * tp / (2 * tp + fp + fn) end) as f1 from ff group by k),
kbest as (select coalesce((select k from cv where f1 > 0 order by round(f1, 12) desc, k limit 1), 5) as k)""",
        _shares_sql(key, key, label, feats, "(select k from kbest)")])


_RUN_METRICS_SQL = """,
c as (select count(*) filter (where y <> 1 and lr <> 1) as tn, count(*) filter (where y <> 1 and lr = 1) as fp,
             count(*) filter (where y = 1 and lr <> 1) as fn, count(*) filter (where y = 1 and lr = 1) as tp
      from te0 join sh on sh.q = te0.c_custkey and sh.n = 1)
select round(case when tn + fp + fn + tp = 0 then 0 else (tn + tp) * 1.0 / (tn + fp + fn + tp) end, 6) as accuracy,
       round(case when tp + fp = 0 then 0 else tp * 1.0 / (tp + fp) end, 6) as precision,
       round(case when tp + fn = 0 then 0 else tp * 1.0 / (tp + fn) end, 6) as recall,
       round(case when 2 * tp + fp + fn = 0 then 0 else 2.0 * tp / (2 * tp + fp + fn) end, 6) as f1,
       tn, fp, fn, tp, cast((select k from kbest) as integer) as n_neighbors, true as auto_k
from c
"""


def _knn_run_sql() -> str:
    feats = CUST_FEATURES
    split = _split_sql("select * from src", "y", "c_custkey", "c_custkey, y, " + ", ".join(feats))
    one, tr = _knn_impute_ctes(5, "distance", "tr0", "tr0", "y", "c_custkey", feats, CUST_IMPUTE, "a")
    two, te = _knn_impute_ctes(5, "distance", "tr0", "te0", "y", "c_custkey", feats, CUST_IMPUTE, "b")
    return _run_sql([
        f"src as (select c_custkey, cast(c_mktsegment = 'BUILDING' as integer) as y, acctbal, nation, custno from ({SQL_CUSTOMER_ROOTS}))",
        f"s as ({split})", "tr0 as (select * from s where split = 'train')", "te0 as (select * from s where split = 'test')",
        *one, *two], tr, te, "c_custkey", "y", feats)


@register("knn_full_run", _knn_run_sql() + _RUN_METRICS_SQL)
def q_knn_full_run(spark, sf_dir):
    """PL-01/03: split, neighbour imputation fitted on the training customers, k by cross-validation, prediction, metrics."""
    from .workflow import run
    c = _customers(spark, sf_dir).withColumn("y", (F.col("c_mktsegment") == "BUILDING").cast("int"))
    return run(c.select("c_custkey", "y", *CUST_FEATURES), "y", "c_custkey", imputer="knn", impute_cols=CUST_IMPUTE)["metrics"]


@register("knn_full_run_predictions", _knn_run_sql() + f"""
select d.c_custkey, d.y, {", ".join(f"round(d.{f}, 6) as {f}" for f in CUST_FEATURES)}, sh.lr as "Prediction",
       round(coalesce((select share from sh o where o.q = d.c_custkey and o.lr = 1), 0), 6) as "Probability"
from db3 d join sh on sh.q = d.c_custkey and sh.n = 1
""")
def q_knn_full_run_predictions(spark, sf_dir):
    """PL-01/03 + KC-08: the imputed test rows of that run with their predictions."""
    from .workflow import run
    c = _customers(spark, sf_dir).withColumn("y", (F.col("c_mktsegment") == "BUILDING").cast("int"))
    return run(c.select("c_custkey", "y", *CUST_FEATURES), "y", "c_custkey", imputer="knn", impute_cols=CUST_IMPUTE)["predictions"]


# --------------------------------------------------------------------------- CL-01..03/06, IM-01..07, AG-06..09, PL-01 with one best solution
GROUP_FEATURES = ["price", "a", "b"]
_SEARCH = {"k_range": (2, 3, 4), "n_init": 4}
SQL_GROUPS = """
  select c_custkey, c_mktsegment, c_custkey % 3 as g,
         case when c_custkey % 15 = 1 then 0.0 else c_custkey % 3 * 1000 + 1 + (c_acctbal + 1000) / 1000 end as price,
         cast(c_custkey % 3 * 100 + c_nationkey / 100 as double) as a, cast((2 - c_custkey % 3) * 50 + sqrt(c_custkey) / 1000 as double) as b
  from customer"""


def _group_stats_sql(cls: str) -> str:
    """CTEs of the groups as clusters of each ``cls``: scaled rows ``z``, sums ``cs``, coefficients ``si``."""
    return f"""
cm as (select {cls}, median(price) filter (where price <> 0) as cmed from src group by {cls}),
fl as (select src.* replace (case when price = 0 then cmed else price end as price) from src join cm using ({cls})),
sp as (select {cls}, {", ".join(f"avg({f}) as m_{f}, stddev_pop({f}) as s_{f}" for f in GROUP_FEATURES)} from fl group by {cls}),
z as (select c_custkey, {cls}, g, {", ".join(f"({f} - m_{f}) / s_{f} as {f}" for f in GROUP_FEATURES)} from fl join sp using ({cls})),
sq as (select *, price * price + a * a + b * b as sq from z),
cs as (select {cls}, g, count(*) as n, sum(sq) as psi, sum(price) as yp, sum(a) as ya, sum(b) as yb from sq group by {cls}, g),
dd as (select x.c_custkey, x.{cls}, x.g as own, c.g, c.n, x.sq + c.psi / c.n - 2 * (x.price * yp + x.a * ya + x.b * yb) / c.n as d
       from sq x join cs c using ({cls})),
ab as (select c_custkey, {cls}, max(case when g = own then d * n / (n - 1) end) as a, min(case when g <> own then d end) as b from dd group by 1, 2),
si as (select {cls}, avg(case when a < b then 1 - a / b when a > b then b / a - 1 else 0 end) as silhouette from ab group by {cls}),
ine as (select {cls}, sum(psi - (yp * yp + ya * ya + yb * yb) / n) as inertia, count(*) as k, string_agg(n, ',' order by n) as sizes
        from cs group by {cls})"""


@register("kmeans_groups_summary", f"""
with src as ({SQL_GROUPS}), {_group_stats_sql("c_mktsegment")}
select c_mktsegment, cast(k as integer) as n_clusters, round(inertia, 3) as inertia, round(silhouette, 6) as silhouette, sizes,
       (select count(*) from src s where s.c_mktsegment = ine.c_mktsegment) as rows,
       round((select count(*) from src s where s.c_mktsegment = ine.c_mktsegment) / k, 6) as rows_per_cluster
from ine join si using (c_mktsegment)
""")
def q_kmeans_groups_summary(spark, sf_dir):
    """CL-01/02/06, AG-06/08/09: k chosen over 2..4 for every segment, inertia, silhouette, cluster sizes and rows per cluster."""
    c = inputs.groups_frame(spark, sf_dir)
    model = impute_kmeans.fit(c, "c_mktsegment", "c_custkey", ["price"], **_SEARCH)
    sizes = model.sizes.groupBy("c_mktsegment").agg(F.concat_ws(",", F.transform(
        F.sort_array(F.collect_list("count")), lambda n: n.cast("string"))).alias("sizes"))
    per = impute_kmeans.class_summary(model).withColumnRenamed("class", "c_mktsegment")
    rows = impute_kmeans.clusters_per_class(model, c).withColumnRenamed("class", "c_mktsegment")
    return per.join(sizes, "c_mktsegment").join(rows, "c_mktsegment").select(
        "c_mktsegment", "n_clusters", F.round("inertia", 3).alias("inertia"), "silhouette", "sizes", "rows", "rows_per_cluster")


@register("kmeans_groups_search", f"""
with src as ({SQL_GROUPS}), {_group_stats_sql("c_mktsegment")}
select c_mktsegment, cast(t.k as integer) as k, round(case when t.k = 3 then silhouette end, 6) as silhouette, t.k = 3 as chosen
from si, (values (2), (3), (4)) t(k)
""")
def q_kmeans_groups_search(spark, sf_dir):
    """CL-06: the ks searched for every segment, the silhouette of the three groups, and which k is chosen."""
    model = impute_kmeans.fit(inputs.groups_frame(spark, sf_dir), "c_mktsegment", "c_custkey", ["price"], **_SEARCH)
    rows = [(str(c), int(k), float(s) if k == 3 else None, model.k[c] == k) for c, k, s, _, _ in model.search.scores]
    return spark.createDataFrame(rows, "c_mktsegment string, k int, silhouette double, chosen boolean")


_GROUP_FILL_SQL = """
md as (select c_mktsegment, median(price) filter (where price <> 0) as med from src where g = 1 group by c_mktsegment)
select c_custkey, c_mktsegment, round(case when price = 0 then med else price end, 6) as price, round(a, 6) as a, round(b, 6) as b
from src join md using (c_mktsegment)
"""


@register("kmeans_groups_impute", f"with src as ({SQL_GROUPS}), {_GROUP_FILL_SQL}")
def q_kmeans_groups_impute(spark, sf_dir):
    """IM-01/02/05, AG-07: class-aware k-means fills of all customers, every value checked."""
    return impute_kmeans.fit_transform(inputs.groups_frame(spark, sf_dir), "c_mktsegment", "c_custkey", ["price"], **_SEARCH)


@register("kmeans_groups_global", f"""
with src as ({SQL_GROUPS}),
md as (select median(price) filter (where price <> 0) as med from src where g = 1)
select c_custkey, c_mktsegment, round(case when price = 0 then med else price end, 6) as price, round(a, 6) as a, round(b, 6) as b
from src cross join md
""")
def q_kmeans_groups_global(spark, sf_dir):
    """CL-03, IM-04: the same fills by one model over all segments."""
    c = inputs.groups_frame(spark, sf_dir)
    return impute_kmeans.fit_transform(c, "c_mktsegment", "c_custkey", ["price"], class_aware=False, **_SEARCH)


@register("kmeans_unseen_class", f"""
with src as (select * replace (case when c_custkey % 11 <> 0 then c_mktsegment end as c_mktsegment) from ({SQL_GROUPS})),
tr as (select * from src where c_mktsegment in ('BUILDING', 'MACHINERY')),
gm as (select median(price) filter (where price <> 0) as gm from tr),
md as (select c_mktsegment, median(price) filter (where price <> 0) as med from tr where g = 1 group by c_mktsegment)
select c_custkey, src.c_mktsegment, round(case when price = 0 then coalesce(med, gm) else price end, 6) as price
from src left join md on src.c_mktsegment = md.c_mktsegment cross join gm
""")
def q_kmeans_unseen_class(spark, sf_dir):
    """IM-03/06: a model fitted on two segments fills all customers; rows of other segments, or of none, take the global median."""
    c = inputs.groups_frame(spark, sf_dir).withColumn("c_mktsegment", F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment")))
    model = impute_kmeans.fit(c.where("c_mktsegment in ('BUILDING', 'MACHINERY')"), "c_mktsegment", "c_custkey", ["price"], **_SEARCH)
    return impute_kmeans.transform(model, c).select("c_custkey", "c_mktsegment", "price")


@register("kmeans_job", f"with src as ({SQL_GROUPS}), {_GROUP_FILL_SQL}")
def q_kmeans_job(spark, sf_dir):
    """IM-07: read a table, fit and transform with the k-means imputer, write the result, read it back."""
    c, source, target = inputs.groups_frame(spark, sf_dir), _shared(spark, "groups"), _shared(spark, "imputed")
    c.write.parquet(source)
    impute_kmeans.impute_dataset(spark, source, target, "c_mktsegment", "c_custkey", ["price"], n_clusters=3, n_init=4)
    return read_table(spark, target, c.schema, "csv")


def _group_run_sql() -> str:
    split = _split_sql("select * from src", "y", "c_custkey", "c_custkey, y, g, " + ", ".join(GROUP_FEATURES))
    filled = "(select t.* replace (case when price = 0 then med else price end as price) from {} t join md using (y))"
    return _run_sql([
        f"src as (select c_custkey, cast(c_mktsegment = 'BUILDING' as integer) as y, g, price, a, b from ({SQL_GROUPS}))",
        f"s as ({split})", "tr0 as (select * from s where split = 'train')", "te0 as (select * from s where split = 'test')",
        "md as (select y, median(price) filter (where price <> 0) as med from tr0 where g = 1 group by y)",
        f"tr1 as {filled.format('tr0')}", f"te1 as {filled.format('te0')}"], "tr1", "te1", "c_custkey", "y", GROUP_FEATURES)


@register("kmeans_full_run", _group_run_sql() + _RUN_METRICS_SQL)
def q_kmeans_full_run(spark, sf_dir):
    """PL-01/03: split, k-means imputation fitted on the training customers, k by cross-validation, prediction, metrics; every value checked."""
    from .workflow import run
    c = inputs.groups_frame(spark, sf_dir).withColumn("y", (F.col("c_mktsegment") == "BUILDING").cast("int"))
    return run(c.select("c_custkey", "y", *GROUP_FEATURES), "y", "c_custkey", imputer="kmeans", impute_cols=["price"], **_SEARCH)["metrics"]


# --------------------------------------------------------------------------- KC-03/04/05
def _mi_sql() -> str:
    lng = " union all ".join(f"select o_orderkey as k, o_orderstatus as y, '{f}' as feature, {f} as v from src"
                             for f in ORDER_FEATURES)
    jit = ("((('0x' || substr(md5(concat_ws('|', '42', x.feature, cast(x.k as varchar))), 1, 8))::UBIGINT"
           " / 4294967296.0) - 0.5)")
    return f"""
with src as ({SQL_ORDERS}),
lng as ({lng}),
sd as (select feature, stddev_pop(v) as sd from lng group by feature),
xs as (select l.*, l.v / case when sd.sd = 0 then 1 else sd.sd end as xs from lng l join sd using (feature)),
ma as (select feature, avg(abs(xs)) as ma from xs group by feature),
ny as (select feature, y, count(*) as n_y from lng group by feature, y),
pts as (select x.feature, x.k, x.y, ny.n_y, least(3, ny.n_y - 1) as kk,
               x.xs + 1e-10 * greatest(1.0, ma.ma) * {jit} as x
        from xs x join ma using (feature) join ny using (feature, y) where ny.n_y > 1),
nb as (select *, x - lag(x, 1) over w as a1, x - lag(x, 2) over w as a2, x - lag(x, 3) over w as a3,
              lead(x, 1) over w - x as b1, lead(x, 2) over w - x as b2, lead(x, 3) over w - x as b3
       from pts window w as (partition by feature, y order by x, k)),
rad as (select feature, k, y, x, kk, n_y,
               list_sort(list_filter([a1, a2, a3, b1, b2, b3], lambda e: e is not null))[kk] as r from nb),
mm as (select a.feature, a.k, greatest(count(*), 1) as m from rad a join pts b
       on a.feature = b.feature and b.x > a.x - a.r * (1.0 - 1e-9) and b.x < a.x + a.r * (1.0 - 1e-9)
       group by a.feature, a.k),
agg as (select r.feature, count(*) as n, avg({digamma_sql("r.kk")}) as pk, avg({digamma_sql("r.n_y")}) as py,
               avg({digamma_sql("mm.m")}) as pm
        from rad r join mm on r.feature = mm.feature and r.k = mm.k group by r.feature)"""


@register("mutual_information", _mi_sql() + """
select feature, round(greatest(""" + digamma_sql("n") + """ + pk - py - pm, 0.0), 6) as score from agg
""")
def q_mutual_information(spark, sf_dir):
    """KC-03: nearest-neighbour mutual information of price, customer and day number with order status."""
    o = inputs.orders_frame(spark, sf_dir)
    return select.mutual_information(o, "o_orderstatus", "o_orderkey", ORDER_FEATURES)


@register("select_features", _mi_sql() + """,
sc as (select feature, greatest(""" + digamma_sql("n") + """ + pk - py - pm, 0.0) as score from agg),
rk as (select feature, row_number() over (order by score desc, feature) as rn from sc)
select feature, cast(rn as integer) as rank from rk where rn <= 2
""")
def q_select_features(spark, sf_dir):
    """KC-04: the two features with the highest mutual information."""
    o = inputs.orders_frame(spark, sf_dir)
    sc = select.mutual_information(o, "o_orderstatus", "o_orderkey", ORDER_FEATURES)
    best = select.top_features(sc, 2, ORDER_FEATURES)
    order = Window.partitionBy().orderBy(F.desc("score"), "feature")  # one row per feature
    return sc.withColumn("rank", F.row_number().over(order)).where(F.col("feature").isin(best)).select("feature", "rank")


@register("feature_importance", _mi_sql() + """
select feature, round(greatest(""" + digamma_sql("n") + """ + pk - py - pm, 0.0), 6) as score from agg
order by score desc, feature limit 5
""")
def q_feature_importance(spark, sf_dir):
    """KC-05: top-5 importance report (features by descending mutual information)."""
    o = inputs.orders_frame(spark, sf_dir)
    return select.importance_report(select.mutual_information(o, "o_orderstatus", "o_orderkey", ORDER_FEATURES))


FLAGSHIP = "prediction_table"
