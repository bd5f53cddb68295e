"""DuckDB SQL for the catalog queries, written against the tables and independent of the Spark code."""

from __future__ import annotations

TABLES = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation",
    "orders", "pages", "part", "region", "supplier",
)

ELEMENTS = "select label, unnest(embedding)::double as x from embeddings"

POSITIONS = """select vec_id, label, unnest(embedding)::double as x,
    generate_subscripts(embedding, 1) - 1 as p from embeddings"""

MEASURES = "select l_returnflag, unnest([l_quantity, l_extendedprice, l_discount, l_tax]) as x from lineitem"

DIAGONAL = f"""with v as (select p, var_pop(x) as variance from ({POSITIONS}) group by p),
t as (select (row_number() over (order by variance desc))::integer as k,
    variance / (select sum(variance) from v) as individual_variance,
    sum(variance) over (order by variance desc rows unbounded preceding) / (select sum(variance) from v) as cum_variance
  from v)"""

# Eigenvalues and eigenvectors of a 2 x 2 covariance in closed form; the larger loading is made positive.
PAIR = """with c as (select var_samp(l_quantity) as a, covar_samp(l_quantity, l_extendedprice) as b,
    var_samp(l_extendedprice) as d, avg(l_quantity) as mq, avg(l_extendedprice) as me from lineitem),
e as (select *, (a + d) / 2 + sqrt(((a - d) / 2) ** 2 + b * b) as l1,
    (a + d) / 2 - sqrt(((a - d) / 2) ** 2 + b * b) as l2 from c),
u as (select *, b / sqrt(b * b + (l1 - a) ** 2) as u0, (l1 - a) / sqrt(b * b + (l1 - a) ** 2) as u1 from e),
w as (select *, case when abs(u0) > abs(u1) then sign(u0) else sign(u1) end as s,
    case when abs(u1) > abs(u0) then -sign(u1) else sign(u0) end as s2 from u)"""



SQUARINGS = 16
DIMENSIONS = 64


def _leading(name: str, source: str) -> str:
    """Leading eigenvector of a symmetric matrix (i, j, v) by repeated squaring; then the deflated matrix."""
    return f"""{name}_p as (
      select 0 as s, i, j, v / (select sum(v) from {source} where i = j) as v from {source}
      union all
      select s, i, j, v / sum(case when i = j then v end) over () as v from
        (select a.s + 1 as s, a.i, b.j, sum(a.v * b.v) as v from {name}_p a join {name}_p b on a.j = b.i
         where a.s < {SQUARINGS} group by all)),
    {name}_m as (select i as m, v as top from {name}_p where s = {SQUARINGS} and i = j order by v desc limit 1),
    {name} as (select i, v / sqrt(top) as u from {name}_p, {name}_m where s = {SQUARINGS} and j = m),
    {name}_l as (select sum(a.u * c.v * b.u) as l from {source} c join {name} a on a.i = c.i join {name} b on b.i = c.j),
    {name}_rest as (select c.i, c.j, c.v - l * a.u * b.u as v
      from {name}_l, {source} c join {name} a on a.i = c.i join {name} b on b.i = c.j)"""


def _spectrum() -> str:
    """Variance table up to 95 %, one deflation after the other."""
    sources = ["cov", *[f"c{i}_rest" for i in range(DIMENSIONS)]]
    steps = ", ".join(_leading(f"c{i}", sources[i]) for i in range(DIMENSIONS))
    values = " union all ".join(f"select {i + 1} as k, l from c{i}_l" for i in range(DIMENSIONS))
    return f"""with recursive e as ({POSITIONS}),
    cov as (select a.p as i, b.p as j, covar_samp(a.x, b.x) as v from e a join e b using (vec_id) group by all),
    {steps}, l as ({values}),
    shares as (select k, l / sum(l) over () as share, sum(l) over (order by k) / sum(l) over () as cum from l),
    variance as (select * from shares where cum - share < 0.95)"""


COMPONENTS = f"""with recursive e as ({POSITIONS}),
    cov as (select a.p as i, b.p as j, covar_samp(a.x, b.x) as v from e a join e b using (vec_id) group by all),
    {_leading("c0", "cov")}, {_leading("c1", "c0_rest")}, {_leading("c2", "c1_rest")},
    mean as (select p, avg(x) as m from e group by p),
    proj as (select vec_id, label, sum(x * c0.u) as p0, sum(x * c1.u) as p1, sum(x * c2.u) as p2,
        sum((x - m) * c0.u) as q0, sum((x - m) * c1.u) as q1
      from e join c0 on c0.i = p join c1 on c1.i = p join c2 on c2.i = p join mean using (p) group by all)"""

BOX = """with e as ({elements}),
x as (select * from e),
q as (select {label}, count(*) as n, quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.5) as median,
    quantile_cont(x, 0.75) as q3 from x group by 1)
select q.{label}, q.n, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
    round(min(x.x) filter (x.x between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)), 6) + 0.0 as whisker_low,
    round(max(x.x) filter (x.x between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)), 6) + 0.0 as whisker_high
from q join x using ({label}) group by all"""

BALANCED = """select event_id, user_id,
    n >= 60 and row_number() over (partition by user_id order by md5('42|' || event_id)) <= 65 as keep
  from (select event_id, user_id, count(*) over (partition by user_id) as n from events)"""

STRATIFIED = """select doc_id, lang, case when rn <= ceil(0.8::double * n) then 'train' else 'test' end as split
  from (select doc_id, lang, row_number() over (partition by lang order by md5('42|' || doc_id)) as rn,
    count(*) over (partition by lang) as n from documents)"""


def _uniform(key: str) -> str:
    return f"(('0x' || substr(md5('42|' || {key}), 1, 8))::ubigint::double / 4294967296.0)"


ORACLES: dict[str, str] = {
    "parquet_round_trip": "select c_custkey, c_name, c_nationkey::bigint as c_nationkey, round(c_acctbal * 2, 2) + 0.0 as c_acctbal from customer",
    "csv_round_trip": f"select vec_id, label::bigint as label, count(*)::integer as n, round(sum(x), 6) + 0.0 as total from ({POSITIONS}) group by vec_id, label",
    "logged_write": """select 'orders' as step, 'whole table' as details, count(*) as rows from orders
        union all select 'supplier', 'whole table', count(*) from supplier""",
    "stage_update": """select '/orders/' || o_orderkey as path, o_custkey as size,
        case when o_orderkey % 5 = 0 or o_orderkey % 7 = 0 then 2 else 1 end as run from orders""",
    "row_count": "select count(*) as n_rows from lineitem",
    "range_classes": "select c_custkey as image_id, c_custkey % 5 as class_id from customer",
    "replicate_rows": """select s_suppkey, s_name, r::integer as copy from supplier,
        (select unnest(generate_series(1, 200)) as r)""",
    "synthetic_features": """with r as (select vec_id, ('0x' || substr(md5('42|' || vec_id), 1, 7))::bigint as s,
            ('0x' || substr(md5('42|' || vec_id), 9, 7))::bigint + 1 as t from embeddings),
        b as (select vec_id, i, (s + i * t) % 2147483647 as x from r, (select unnest(generate_series(0, 1279)) as i)),
        q as (select *, x * x % 2147483647 as x2 from b),
        v as (select vec_id, i, (x2 * x2 % 2147483647) * x % 2147483647 / 2147483647.0::double as x from q)
        select vec_id, count(*)::integer as n, round(max(x) filter (i = 0), 9) as first_value,
          round(max(x) filter (i = 1279), 9) as last_value, round(max(x), 9) as max_value, round(sum(x), 5) as total
        from v group by vec_id""",
    "vector_shape": """select count(*) as n_rows, count(embedding) as n_vectors, min(len(embedding))::integer as min_length,
        max(len(embedding))::integer as max_length from embeddings""",
    "dataset_inventory": " union all ".join(
        f"select '{t}.parquet' as dataset, true as readable, (select count(*) from {t}) as rows, "
        f"(select count(*) from (describe select * from {t}))::integer as n_columns, "
        f"(select string_agg(column_name, ',') from (describe select * from {t})) as columns, "
        "true as has_bytes, 0::bigint as part_files"
        for t in TABLES
    ),
    "part_files": "select distinct 'o_orderstatus=' || o_orderstatus as directory, 1::bigint as part_files, 1::bigint as crc_files from orders",
    "directory_size": """select 2 * count(distinct o_orderstatus) + 2 as files, count(distinct o_orderstatus) as directories, true as has_bytes
        from orders""",
    "integrity": """select 'embeddings.parquet' as path, true as exists, true as valid, count(*) as rows from embeddings
        union all select 'documents.parquet', true, true, count(*) from documents
        union all select 'final_results.parquet', false, false, 0""",
    "integrity_status": """select count(*) as expected, count(*) filter (n > 0) as valid,
          case when count(*) = count(*) filter (n > 0) then 'OK' else 'INCOMPLETE' end as status
        from (select count(*) as n from embeddings union all select count(*) from documents union all select 0)""",
    "path_label": """select page_id, url, case when len(string_split(url, '/')) >= 2
        then string_split(url, '/')[-2] end as label from pages""",
    "path_label_regex": """select * from (select page_id, url,
        regexp_extract(url, 'example\\.[a-z]+/([^/]+)/', 1) as label from pages) where label <> ''""",
    "class_names": """select o_orderkey, o_orderkey % 5 as class_id, case o_orderkey % 5 when 0 then 'Apple_Red'
        when 1 then 'Banana' when 2 then 'Orange' when 3 then 'Strawberry' else 'Grape_White' end as fruit_label
        from orders""",
    "url_class": """with k as (select regexp_replace(url, '^https?://[^/]+/', '') as key, length(html) as size from pages)
        select case when key like 'en/%' then 'results' when key like 'fr/%' then 'cache'
          when key like 'de/%' then 'plots' else 'test' end as type,
          count(*) as objects, sum(size)::bigint as bytes from k group by 1""",
    "url_class_marked": """with k as (select page_id, regexp_replace(url, '^https?://[^/]+/', '') as key from pages)
        select page_id, case when key like 'en/%' or contains(key, 'utm_source') then 'results'
          when key like 'fr/%' then 'cache' when key like 'de/%' then 'plots' else 'other' end as type from k""",
    "expected_results": """select 'utm_source' as expected, count(*) filter (contains(url, 'utm_source')) > 0 as found
        from pages union all
        select 'final_results', count(*) filter (contains(url, 'final_results')) > 0 from pages""",
    "class_counts": "select label, count(*) as n from embeddings group by label",
    "class_share": """select lang, count(*) as n, round(count(*) * 100.0::double / sum(count(*)) over (), 6) as percent
        from documents group by lang""",
    "class_relative": """with c as (select lang, count(*) as n from documents group by lang)
        select lang, n, round(n::double / max(n) over (), 6) as relative,
          floor(n::double / max(n) over () * 25)::integer as steps from c""",
    "class_balance": """with c as (select event_type, count(*) as n from events group by 1)
        select count(*) as n_classes, min(n) as min_n, max(n) as max_n, sum(n)::bigint as total,
          round(min(n)::double / max(n), 6) as balance_ratio,
          round((max(n) - min(n)) * 100.0::double / sum(n), 6) as spread_percent from c""",
    "distinct_classes": "select count(distinct source) as n_classes from documents",
    "class_list": "select distinct source from documents",
    "class_sample": """select string_split(url, '/')[-2] as label, min(url) as sample_url from pages
        group by 1""",
    "null_profile": """with e as (select * replace (nullif(event_type, 'error') as event_type,
            case when value < 100 then value end as value, case when user_id % 7 > 0 then user_id end as user_id) from events)
        """
    + " union all ".join(
        f"""select '{c}' as "column", '{t}' as dtype, count(*) as n_rows, count(*) - count({c}) as n_null,
          round((count(*) - count({c}))::double / count(*) * 100, 6) as percent_null from e"""
        for c, t in (
            ("event_id", "bigint"), ("ts", "timestamp"), ("user_id", "bigint"), ("event_type", "string"),
            ("value", "double"), ("props", "string"),
        )
    ),
    "frame_summary": " union all ".join(
        f"select '{c}' as \"column\", '{t}' as dtype, count(*) as n_rows, count(*) - count({c}) as n_null from documents"
        for c, t in (
            ("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"),
        )
    ),
    "inspect_dataset": " union all ".join(
        f"select '{c}' as \"column\", '{t}' as dtype, count(*) as n_rows, count(*) - count({c}) as n_null from supplier"
        for c, t in (("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double"))
    ),
    "frame_check": """select 'frame' as rule, true as passed union all
        select 'min_rows', count(*) >= 1000 from lineitem union all
        select 'column:l_orderkey', true union all select 'column:label', false""",
    "feature_stats": f"""select count(x) as n_values, count(*) filter (not isfinite(x)) as n_nonfinite, round(min(x), 6) as min_value, round(max(x), 6) as max_value,
        round(avg(x), 6) + 0.0 as mean_value, round(stddev_pop(x), 6) as std_value from ({ELEMENTS})""",
    "lineitem_feature_stats": f"""select count(x) as n_values, count(*) filter (not isfinite(x)) as n_nonfinite, round(min(x), 6) as min_value, round(max(x), 6) as max_value,
        round(avg(x), 4) as mean_value, round(stddev_pop(x), 4) as std_value from ({MEASURES})""",
    "feature_histogram": f"""with e as ({ELEMENTS}), r as (select min(x) as lo, max(x) as hi from e),
        b as (select least(floor((x - lo) / (hi - lo) * 50)::integer, 49) as bin, count(*) as n from e, r group by 1)
        select i::integer as bin, round(lo + i * ((hi - lo) / 50), 6) + 0.0 as bin_start,
          round(lo + (i + 1) * ((hi - lo) / 50), 6) + 0.0 as bin_end, coalesce(n, 0) as n
        from r, (select unnest(generate_series(0, 49)) as i) left join b on b.bin = i""",
    "class_box_stats": BOX.format(elements=ELEMENTS, label="label"),
    "lineitem_box_stats": BOX.format(elements=MEASURES, label="l_returnflag"),
    "component_correlation": f"""with e as (select * from ({POSITIONS}))
        select a.p::integer as i, b.p::integer as j, round(corr(a.x, b.x), 6) + 0.0 as corr
        from e a join e b using (vec_id) group by all""",
    "component_variance": f"""select p::integer as position, round(var_pop(x), 8) as variance from ({POSITIONS})
        group by p""",
    "covariance_long": f"""with e as ({POSITIONS})
        select a.p::integer as i, b.p::integer as j, round(covar_samp(a.x, b.x), 8) + 0.0 as covariance
        from e a join e b using (vec_id) group by all""",
    "lineitem_covariance": " union all ".join(
        f"select {i} as i, {j} as j, round(covar_samp({a}, {b}), 3) + 0.0 as covariance from lineitem"
        for i, a in enumerate(("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
        for j, b in enumerate(("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    ),
    "total_variance": f"""select round(sum(v), 6) as total_variance from
        (select var_samp(x) as v from ({POSITIONS}) group by p)""",
    "assemble_columns": """select l_orderkey, l_linenumber, l_quantity as v_0, l_extendedprice as v_1,
        l_discount as v_2, l_tax as v_3 from lineitem""",
    "expand_vector": "select vec_id, label, "
    + ", ".join(f"embedding[{i + 1}]::double as pca_{i}" for i in range(64))
    + " from embeddings",
    "hash_sample": "select doc_id, lang from documents order by md5('42|' || doc_id), doc_id limit 100",
    "min_class_filter": """select event_id, user_id from events
        where user_id in (select user_id from events group by 1 having count(*) >= 70)""",
    "excluded_classes": """select count(*) as excluded_classes from
        (select user_id from events group by 1 having count(*) < 70)""",
    "balance_exact": """select doc_id, lang from documents
        qualify row_number() over (partition by lang order by md5('42|' || doc_id)) <= 100""",
    "balance_bernoulli": f"""select doc_id, lang from (select doc_id, lang, count(*) over (partition by lang) as n
        from documents) where {_uniform("doc_id")} < 100.0::double / n""",
    "balance_dataset": f"select event_id, user_id from ({BALANCED}) where keep",
    "reduction_report": f"""select count(*) as initial, count(*) filter (keep) as final,
        count(*) filter (not keep) as rejected,
        round(count(*) filter (not keep) * 100.0::double / count(*), 6) as percent_reduction from ({BALANCED})""",
    "hash_split": """select doc_id, case when ('0x' || substr(md5('42|' || doc_id), 1, 8))::ubigint % 10000 < 8000
        then 'train' else 'test' end as split from documents""",
    "stratified_split": STRATIFIED,
    "split_report": f"""select split, count(*) as n, round(count(*) * 100.0::double / sum(count(*)) over (), 6) as percent
        from ({STRATIFIED}) group by split""",
    "union_splits": "select doc_id, lang from documents",
    "prepare_data": """select vec_id, label, case when ('0x' || substr(md5('42|' || vec_id), 1, 8))::ubigint % 10000 < 8000
        then 'train' else 'test' end as part, len(embedding)::integer as length from embeddings""",
    "variance_curve": f"""{DIAGONAL}
        select k, round(individual_variance, 6) as individual_variance, round(cum_variance, 6) as cum_variance,
          0.95::double as threshold, k = (select min(k) from t where cum_variance >= 0.95) as chosen from t""",
    "optimal_k": f"""{DIAGONAL}
        select k, round(cum_variance, 6) as cum_variance, true as reached from t
        where cum_variance >= 0.9 order by k limit 1""",
    "k_fallback": f"""{DIAGONAL}
        select 500 as requested, k, round(cum_variance, 6) as cum_variance from t
        where cum_variance >= 0.8 order by k limit 1""",
    "reduction_factor": f"""{DIAGONAL}
        select k, round(64.0::double / k, 6) as reduction_factor,
          round((64 - k) * 100.0::double / 64, 6) as percent_reduction from t""",
    "quality_verdict": f"""{DIAGONAL},
        c as (select label, count(*) as n from embeddings group by 1),
        m as (select sum(n)::bigint as n_rows, count(*) as n_classes, min(n)::double / max(n) as ratio,
            (max(n) - min(n)) * 100.0::double / sum(n) as spread from c),
        e as (select max(k) as k, max(cum_variance) as cum, true as reached from
            (select k, cum_variance from t where cum_variance >= 0.95 order by k limit 1))
        select n_rows, n_classes, k, round(cum, 6) as explained_variance, reached, round(ratio, 6) as balance_ratio,
          round(spread, 6) as spread_percent,
          case when ratio > 0.8 then 'balanced' else 'unbalanced' end as balance,
          case when cum > 0.8 then 'reached' else 'not reached' end as variance,
          case when cum > 0.8 and ratio > 0.7 then 'success' else 'partial success' end as overall
        from m, e""",
    "pca_variance": f"""{_spectrum()}
        select k, round(share, 6) as individual_variance, round(cum, 6) as cum_variance from variance""",
    "pca_variance_random": f"""{_spectrum()}
        select k, round(share, 6) as individual_variance, round(cum, 6) as cum_variance from variance where k <= 8""",
    "pca_project": f"""{_spectrum()},
        u as ({" union all ".join(f"select {i} as component, i, u from c{i}" for i in range(DIMENSIONS))})
        select vec_id, label, component::integer as component, round(sum(x * u), 6) + 0.0 as value
        from e join u on i = p where component < (select count(*) from variance) group by all""",
    "reduce_report": f"""{_spectrum()},
        c as (select label, count(*) as n from embeddings group by 1),
        m as (select sum(n)::bigint as n_rows, count(*) as n_classes, min(n)::double / max(n) as ratio,
            (max(n) - min(n)) * 100.0::double / sum(n) as spread from c),
        t as (select max(k) as k, max(cum) as cum from variance)
        select n_rows, n_classes, k, round(cum, 6) as explained_variance, cum >= 0.95 as reached, round(ratio, 6) as balance_ratio,
          round(spread, 6) as spread_percent,
          case when ratio > 0.8 then 'balanced' else 'unbalanced' end as balance,
          case when cum > 0.8 then 'reached' else 'not reached' end as variance,
          case when cum > 0.8 and ratio > 0.7 then 'success' else 'partial success' end as overall
        from m, t""",
    "pca_variance_pair": f"""{PAIR}
        select 1 as k, round(l1 / (l1 + l2), 9) as individual_variance, round(l1 / (l1 + l2), 9) as cum_variance from w
        union all select 2, round(l2 / (l1 + l2), 9), 1.0::double from w""",
    "pca_spectrum": f"""with e as ({POSITIONS}),
        c as (select a.p as i, b.p as j, covar_samp(a.x, b.x) as v from e a join e b using (vec_id) group by all)
        select count(distinct i) as k, 1.0::double as shares,
          round(sum(v * v) / (sum(v) filter (i = j) * sum(v) filter (i = j)), 8) as squares from c""",
    "pca_project_pair": f"""{PAIR}
        select l_orderkey, l_linenumber, round(s * (l_quantity * u0 + l_extendedprice * u1), 4) + 0.0 as pca_0,
          round(s2 * (l_quantity * -u1 + l_extendedprice * u0), 4) + 0.0 as pca_1 from lineitem, w""",
    "pca_planar_pair": f"""{PAIR}
        select l_orderkey, l_linenumber,
          round(s * ((l_quantity - mq) * u0 + (l_extendedprice - me) * u1), 4) + 0.0 as x,
          round(s2 * ((l_quantity - mq) * -u1 + (l_extendedprice - me) * u0), 4) + 0.0 as y from lineitem, w""",
    "pca_first": f"""{COMPONENTS}
        select vec_id, round(p0, 6) + 0.0 as pca_0, round(p1, 6) + 0.0 as pca_1, round(p2, 6) + 0.0 as pca_2 from proj""",
    "pca_2d": f"""{COMPONENTS}
        select vec_id, label, round(q0, 6) + 0.0 as x, round(q1, 6) + 0.0 as y from proj""",
    "class_means": f"""{COMPONENTS}
        select label, count(*) as n, round(avg(p0), 6) + 0.0 as mean_0, round(avg(p1), 6) + 0.0 as mean_1,
          round(avg(p2), 6) + 0.0 as mean_2, round(count(*) * 100.0::double / sum(count(*)) over (), 6) as percent
        from proj group by label""",
    "pca_norms": f"select vec_id, round(sqrt(sum(x * x)), 6) as norm from ({POSITIONS}) group by vec_id",
    "label_index": """select source, n, (row_number() over (order by n desc, source) - 1)::double as label_indexed
        from (select source, count(*) as n from documents group by source)""",
    "label_index_ids": """select user_id, n, (row_number() over (order by n desc, user_id::varchar) - 1)::double as label_indexed
        from (select user_id, count(*) as n from events group by user_id)""",
    "synthetic_reduction": """with r as (select vec_id, ('0x' || substr(md5('42|' || vec_id), 1, 7))::bigint as s,
            ('0x' || substr(md5('42|' || vec_id), 9, 7))::bigint + 1 as t from embeddings),
        b as (select vec_id, i, (s + i * t) % 2147483647 as x from r, (select unnest(generate_series(0, 1279)) as i)),
        q as (select *, x * x % 2147483647 as x2 from b),
        v as (select vec_id, i, (x2 * x2 % 2147483647) * x % 2147483647 / 2147483647.0::double as x from q),
        c as (select vec_id, i, x - avg(x) over (partition by i) as x from v),
        l as (select vec_id, list(x order by i) as x from c group by vec_id),
        g as (select a.vec_id = b.vec_id as same, list_inner_product(a.x, b.x) as g from l a, l b)
        select (select count(*) from embeddings) as n_rows, 100 as length, 1.0::double as shares,
          round(sum(g * g) / (sum(g) filter (same) * sum(g) filter (same)), 8) as squares from g""",
    "rf_predict": """with s as (select vec_id, label, row_number() over (partition by label order by md5('42|' || vec_id)) as rn,
            count(*) over (partition by label) as n from embeddings),
        i as (select label, (row_number() over (order by count(*) desc, label::varchar) - 1)::double as x
          from s where rn <= ceil(0.8::double * n) group by label)
        select vec_id, label, x as label_indexed, x as prediction, label::varchar as predicted_label
        from s join i using (label) where rn > ceil(0.8::double * n)""",
    "kmeans_assign": "select vec_id, label, label as cluster_label from embeddings",
    "cluster_chart": f"""{COMPONENTS}
        select vec_id, round(q0, 6) + 0.0 as x, round(q1, 6) + 0.0 as y, label, label as cluster_label from proj""",
    "class_metrics": """with l as (select quality as a, toxic as p from labels),
        c as (select distinct unnest([quality, toxic]) as c from labels),
        s as (select c, (select count(*) from l where a = c) as na, (select count(*) from l where p = c) as np,
            (select count(*) from l where a = c and p = c) as hit from c),
        m as (select na, hit, case when np > 0 then hit::double / np else 0 end as pr,
            case when na > 0 then hit::double / na else 0 end as re from s),
        f as (select *, case when pr + re > 0 then 2 * pr * re / (pr + re) else 0 end as f1 from m)
        select round(sum(hit)::double / sum(na), 6) as accuracy, round(sum(f1 * na) / sum(na), 6) as f1_score,
          round(sum(pr * na) / sum(na), 6) as precision, round(sum(re * na) / sum(na), 6) as recall from f""",
    "confusion_matrix": """with c as (select distinct unnest([quality, toxic]) as c from labels)
        select a.c as actual, p.c as predicted,
          (select count(*) from labels where quality = a.c and toxic = p.c) as n from c a, c p""",
    "silhouette": """with d as (select a.vec_id, a.label as la, b.label as lb,
            sum(list_distance(a.embedding::double[], b.embedding::double[]) ** 2) as total, count(*) as n
          from embeddings a, embeddings b group by all),
        m as (select vec_id, max(total / nullif(n - 1, 0)) filter (la = lb) as own,
            min(total / n) filter (la <> lb) as other from d group by vec_id)
        select round(avg(case when own is null then 0 else (other - own) / greatest(own, other) end), 6) as silhouette
        from m""",
    "image_features": """with p as (select vec_id, unnest(embedding)::double as v from embeddings),
        s as (select vec_id, floor((v + 1) * 127.5) as px from p),
        h as (select vec_id, least(floor(px / 127.5 * 8), 15) as cell, count(*) as n from s group by all),
        t as (select vec_id, max(n) / 64.0::double as largest_share, sum(n) / 64.0::double as share_sum from h group by 1)
        select vec_id, 'ok' as status, 320 as length, sum(px)::bigint as pixel_sum,
          round(max(px) / 127.5 - 1, 5) as tile_max, round(any_value(largest_share), 5) as largest_share,
          round(any_value(share_sum), 5) as share_sum from s join t using (vec_id) group by vec_id""",
    "image_descriptor": """with t as (select n, i // 14 as tile, least(greatest((i + 0.5::double) * n / 224 - 0.5, 0), n - 1) as pos
          from (select unnest(generate_series(0, 223)) as i), (select unnest([2, 11]) as n)),
        taps as (select n, tile, floor(pos)::bigint as p, 1 - (pos - floor(pos)) as w from t
          union all select n, tile, least(floor(pos)::bigint + 1, n - 1), pos - floor(pos) from t),
        w as (select n, tile, p, sum(w) / 14 as w from taps group by all),
        px as (select vec_id, generate_subscripts(embedding, 1) - 1 as k, floor((unnest(embedding)::double + 1) * 127.5) as v
          from embeddings union all select vec_id, unnest([64, 65]), 0 from embeddings),
        tiles as (select vec_id, 2 - k % 3 as plane, r.tile as i, c.tile as j, sum(r.w * c.w * v) / 127.5 - 1 as x
          from px join w r on r.n = 2 and r.p = k // 33 join w c on c.n = 11 and c.p = k // 3 % 11 group by all),
        planes as (from tiles union all select vec_id, 3, i, j,
          sum(x * case plane when 0 then 0.299::double when 1 then 0.587::double else 0.114::double end) from tiles group by all)
        select vec_id, plane::integer as plane, 1280 as length, round(avg(x), 2) + 0.0 as mean_tile,
          round(avg(x * x), 2) + 0.0 as mean_square, 1.0::double as share_sum from planes group by vec_id, plane""",
    "image_scan": """select vec_id, label::varchar as label, 8 as height, 8 as width, 1 as "nChannels",
        sum(floor((x + 1) * 127.5))::bigint as total from (select vec_id, label, unnest(embedding)::double as x from embeddings) group by vec_id, label""",
    "image_files": """select kind, label::varchar as label, count(*) as n from embeddings, (select unnest(['indexed', 'scanned', 'charts']) as kind)
          group by kind, label union all select 'inputs', '', count(*) from embeddings""",
    "image_failures": """with k as (select vec_id, vec_id % 10 as kind from embeddings)
        select vec_id, mode, case kind when 1 then 'error' when 2 then 'rejected' when 3 then 'rejected' else 'ok' end as status,
          case kind when 2 then 'too small: 2x1' when 3 then 'unreadable' else 'OK' end as reason,
          case when kind in (2, 3) or kind = 1 and mode = 'null' then null else 320 end::integer as length,
          case when kind in (2, 3) or kind = 1 and mode = 'null' then null else kind <> 1 end as any_value
        from k, (select unnest(['zero', 'null']) as mode)""",
    "image_validation": """select p_partkey, case when p_size = 50 then 'corrupt' when p_size = 49 then 'unreadable'
          when p_size < 32 or p_partkey % 64 < 32 then 'too small: ' || p_size || 'x' || p_partkey % 64 else 'OK' end as reason,
          p_size < 49 and p_size >= 32 and p_partkey % 64 >= 32 as valid from part""",
}
