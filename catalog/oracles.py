"""The same queries as SQL on the same tables, written independently of the library."""

from __future__ import annotations

DIMENSIONS = 64

LABELLED = """
    select d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
    from documents d left join labels l on d.doc_id = l.doc_id
"""

# One row per document and dimension; v is null for documents without an embedding.
WIDE_LONG = """
    select d.doc_id, t.i, cast(e.embedding[t.i + 1] as double) as v
    from documents d left join embeddings e on e.vec_id = d.doc_id, range(64) t(i)
"""

EMBEDDING_LONG = """
    select vec_id, t.i, cast(embedding[t.i + 1] as double) as v from embeddings, range(64) t(i)
"""

EVENTS = """
    select event_id, case when event_type = 'error' then 1 else 0 end as label, value as score,
           case when value > 50 then 1.0 else 0.0 end as prediction
    from events
"""

LINES = """
    select concat(l_orderkey, '-', l_partkey, '-', l_suppkey, '-', l_linenumber) as line_id,
           concat(l_returnflag, l_linenumber) as kind,
           case when l_linestatus = 'O' then 1 else 0 end as label
    from lineitem
"""


def index_map(table: str, *columns: str) -> str:
    return " union all ".join(
        f"""select '{c}' as "column", label, n,
                   cast(row_number() over (order by n desc, label) - 1 as bigint) as "index"
            from (select cast({c} as varchar) as label, cast(count(*) as bigint) as n from {table} group by 1)"""
        for c in columns
    )


def extremes(table: str, *columns: str) -> str:
    return " union all ".join(
        f"select '{c}' as \"column\", min({c}) as low, max({c}) as high from {table}" for c in columns
    )


def medians(table: str, *columns: str) -> str:
    return " union all ".join(
        f"select '{c}' as \"column\", quantile_disc({c}, 0.5) as median from {table}" for c in columns
    )


def class_rates(scored: str) -> str:
    """Rates per label of rows (label, prediction)."""
    return f"""
        select cast(c.label as double) as label,
               coalesce(sum(case when s.label = c.label and s.prediction = c.label then 1.0 else 0.0 end)
                   / nullif(sum(case when s.prediction = c.label then 1 else 0 end), 0), 0.0) as precision,
               sum(case when s.label = c.label and s.prediction = c.label then 1.0 else 0.0 end)
                   / sum(case when s.label = c.label then 1 else 0 end) as recall,
               sum(case when s.label = c.label and s.prediction = c.label then 1.0 else 0.0 end)
                   / sum(case when s.label = c.label then 1 else 0 end) as true_positive_rate,
               sum(case when s.label <> c.label and s.prediction = c.label then 1.0 else 0.0 end)
                   / nullif(sum(case when s.label <> c.label then 1 else 0 end), 0) as false_positive_rate
        from ({scored}) s, (select distinct label from ({scored}) where label is not null) c
        where s.label is not null
        group by c.label
    """


def curve_points(scored: str) -> str:
    return f"""
        select 0.0 as x, 0.0 as y
        union all select 1.0, 1.0
        union all
        select cast(sum(n) over w as double) / sum(n) over (), cast(sum(p) over w as double) / sum(p) over ()
        from (select score, sum(label) as p, sum(1 - label) as n from ({scored}) group by score)
        window w as (order by score desc rows between unbounded preceding and current row)
    """


def area(scored: str) -> str:
    return f"""
        select sum((x - px) * (y + py) / 2) as area
        from (select x, y, lag(x) over (order by x, y) as px, lag(y) over (order by x, y) as py
              from ({curve_points(scored)}))
    """


def report(scored: str, digits: int) -> str:
    long = " union all ".join(
        f"select '{m}' as metric, label, round({m}, {digits}) as value from ({class_rates(scored)})"
        for m in ("precision", "recall", "true_positive_rate", "false_positive_rate")
    )
    return f"""
        {long}
        union all select distinct 'label', cast(label as double), cast(label as double) from ({scored})
        union all select 'accuracy', null, round(avg(case when label = prediction then 1.0 else 0.0 end), {digits})
                  from ({scored})
        union all select 'area_under_roc', null, round(area, {digits}) from ({area(scored)})
    """


# A saturated fit: the score of a line is the share of positives of its kind.
FITTED_LINES = f"""
    select l.label, r.score, case when r.score > 0.5 then 1 else 0 end as prediction
    from ({LINES}) l join (select kind, avg(label) as score from ({LINES}) group by kind) r on l.kind = r.kind
"""

IMPUTED_LONG = f"""
    select w.doc_id, w.i, coalesce(w.v, m.median) as v, m.low, m.high
    from ({WIDE_LONG}) w
    join (select i, quantile_disc(v, 0.5) as median, min(v) as low, max(v) as high
          from ({WIDE_LONG}) where v is not null group by i) m on w.i = m.i
"""


def feature_rows(value: str, extra_slots: int) -> str:
    """One summary row per document; ``value`` is the unscaled block value of IMPUTED_LONG's columns."""
    slots = {
        c: f"select label, row_number() over (order by n desc, label) - 1 as slot, count(*) over () as labels "
        f"from (select {c} as label, count(*) as n from documents group by 1)"
        for c in ("lang", "source")
    }
    return f"""
        select d.doc_id,
               cast(1 + {DIMENSIONS} + a.labels + b.labels + 2 * {extra_slots} as bigint) as width,
               round(ln(d.n_chars + 1), 6) as amount,
               round(s.total, 5) as block_total,
               round(s.weighted, 5) as block_weighted,
               round(ln(d.n_chars + 1) + s.total + 2, 5) as total,
               cast(a.slot as bigint) as lang_slot, cast(a.labels + {extra_slots} as bigint) as lang_width,
               cast(b.slot as bigint) as source_slot, cast(b.labels + {extra_slots} as bigint) as source_width
        from documents d
        join ({slots['lang']}) a on d.lang = a.label
        join ({slots['source']}) b on d.source = b.label
        join (select doc_id, sum(x) as total, sum((i + 1) * x) as weighted
              from (select doc_id, i, ({value} - low) / (high - low) as x from ({IMPUTED_LONG}))
              group by doc_id) s on d.doc_id = s.doc_id
    """


def document_index() -> str:
    return """
        select d.doc_id, d.lang, cast(coalesce(m.pos, (select count(*) from labels)) as double) as doc_idx
        from documents d
        left join (select doc_id, row_number() over (order by n desc, cast(doc_id as varchar)) - 1 as pos
                   from (select doc_id, count(*) as n from labels group by 1)) m on d.doc_id = m.doc_id
    """


def joined_indexes(*columns: str) -> str:
    known = "lineitem where l_returnflag = 'R'"
    indices = ", ".join(
        f"cast(coalesce({c}_m.pos, (select count(distinct {c}) from {known})) as double) as {c}_idx" for c in columns
    )
    joins = " ".join(
        f"""left join (select {c} as label, row_number() over (order by n desc, cast({c} as varchar)) - 1 as pos
                       from (select {c}, count(*) as n from {known} group by 1)) {c}_m on {c}_m.label = i.{c}"""
        for c in columns
    )
    return f"""
        select {", ".join(f"i.{c}" for c in columns)}, cast(i.l_linenumber as bigint) as l_linenumber, {indices}
        from lineitem i {joins}
    """


def mixed(value: str) -> str:
    line = "((x % base) * a[t + 1] + b[t + 1]) % 2147483647"
    return f"""list_reduce(range(0, 6), lambda x, t:
        (x % base) * base + (x // base + (({line}) * ({line}) + c[t + 1]) % 2147483647) % base, {value})"""


def dimension_columns(expression: str) -> str:
    return ", ".join(f'{expression.format(i=i, place=i + 1)} as "E{i}"' for i in range(DIMENSIONS))


ORACLES: dict[str, str] = {
    "scan_csv_typed": """
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate
        from orders
    """,
    "csv_type_evidence": r"""
        with t as (
            select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey, o_orderstatus,
                   cast(o_totalprice as varchar) as o_totalprice, o_orderpriority,
                   strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as stamp, strftime(o_orderdate, '%Y-%m-%d') as "day",
                   cast(o_totalprice > 1000 as varchar) as dear,
                   case when o_orderstatus = 'P' then 'part ' || o_orderpriority
                        else cast(o_custkey as varchar) end as note,
                   case when o_orderstatus <> 'P' then lpad(cast(o_custkey as varchar), 9, '0') end as code,
                   case when o_orderstatus = 'P' then cast(o_orderkey * 10000000000 as varchar) end as "wide"
            from orders),
        cells as (select "column", cell from t unpivot include nulls (cell for "column" in (columns(*)))),
        kinds as (
            select *, case
                when cell is null then null
                when regexp_full_match(cell, '[+-]?[0-9]+') and try_cast(cell as bigint) between -2147483648 and 2147483647
                    then 'int'
                when regexp_full_match(cell, '[+-]?[0-9]+') and try_cast(cell as bigint) is not null then 'bigint'
                when try_cast(cell as double) is not null then 'double'
                when lower(cell) in ('true', 'false') then 'boolean'
                when length(cell) = 10 and try_cast(cell as date) is not null then 'date'
                when try_cast(cell as timestamp) is not null then 'timestamp_ntz'
                else 'string' end as kind
            from cells),
        counts as (
            select "column", count(cell) as "values", count(*) - count(cell) as nulls,
                   count(*) filter (where cell[1] = '0' and length(cell) > 1 and kind in ('int', 'bigint')) as padded,
                   count(*) filter (where kind in ('int', 'bigint', 'double')) as numbers,
                   count(*) filter (where kind = 'bigint') as big, count(*) filter (where kind = 'double') as fractions,
                   count(*) filter (where kind = 'boolean') as flags, count(*) filter (where kind = 'date') as dates,
                   count(*) filter (where kind = 'timestamp_ntz') as stamps
            from kinds group by 1),
        typed as (
            select *, case when fractions > 0 then 'double' when big > 0 then 'bigint' else 'int' end as number_type
            from counts),
        judged as (
            select *, case
                when "values" = 0 then 'string'
                when numbers = "values" then number_type
                when dates + stamps = "values" then case when stamps > 0 then 'timestamp_ntz' else 'date' end
                when flags = "values" then 'boolean' else 'string' end as type,
                case when numbers > 0 and numbers < "values" and 2 * numbers >= "values" then number_type end as mostly
            from typed),
        odd as (
            select k."column", count(*) as misfits, min(cell) as example
            from kinds k join judged j using ("column")
            where j.mostly is not null and cell is not null and kind not in ('int', 'bigint', 'double') group by 1)
        select "column", type, "values", nulls, padded, mostly, misfits, example from judged left join odd using ("column")
    """,
    "csv_proposed_read": """
        select o_orderkey, o_totalprice, o_orderstatus, o_totalprice > 1000 as dear from orders
    """,
    "scan_parquet_project": "select o_orderkey as order_key, o_custkey as customer, o_totalprice as price from orders",
    "sink_parquet_roundtrip": "select c_custkey, c_name, c_acctbal, c_mktsegment from customer",
    "left_join_enrich": f"""
        select doc_id, lang, source, n_chars, cast(quality as bigint) as quality, cast(toxic as bigint) as toxic
        from ({LABELLED})
    """,
    "left_join_salted": """
        select c_custkey as custkey, c_name, o_orderkey, o_totalprice
        from customer left join orders on c_custkey = o_custkey
    """,
    "sink_published_state": """
        select c_custkey, c_name, c_acctbal, c_mktsegment, (select count(*) from customer) as rows_told from customer
    """,
    "left_join_hot_keys": """
        select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, suppkey, s_name, s_acctbal
        from (select *, cast(case when l_linenumber <= 2 then 1 else l_suppkey end as bigint) as suppkey from lineitem)
        left join supplier on s_suppkey = suppkey
    """,
    "category_index_apply_joined": joined_indexes("l_orderkey", "l_partkey", "l_suppkey"),
    # A Poisson number is the first k whose distribution's sum is above the hash.
    "oversample_poisson": f"""
        with classes as (
            select count(*) filter (toxic = 0)::double / count(*) filter (toxic = 1) as ratio from ({LABELLED})
        ),
        means as (select ratio / ceil(ratio / 16) as mean, ceil(ratio / 16)::bigint as draws from classes),
        terms as (select k, exp(k * ln(mean) - mean - lgamma(k + 1)) as term from means, range(0, 200) r(k)),
        sums as (select k, sum(term) over (order by k) as upto from terms),
        hashes as (
            select doc_id, n, ('0x' || substr(md5('42:' || n || ':' || doc_id || ':0'), 1, 8))::bigint / 4294967296 as u
            from ({LABELLED}), means, range(0, draws) r(n) where toxic = 1
        ),
        drawn as (select doc_id, count(upto) as copies from hashes left join sums on upto <= u group by doc_id)
        select doc_id, 1::bigint as toxic from drawn, range(0, copies)
        union all
        select doc_id, 0::bigint as toxic from ({LABELLED}) where toxic = 0
    """,
    # Two digits to the base of the root of the row count; each round adds a function of the lower to the upper.
    "shuffle_positions": """
        with keys as (
            select list_transform(range(0, 6), lambda t: ('0x' || substr(md5('42:' || t || ':a'), 1, 15))::bigint % 2147483647) as a,
                   list_transform(range(0, 6), lambda t: ('0x' || substr(md5('42:' || t || ':b'), 1, 15))::bigint % 2147483647) as b,
                   list_transform(range(0, 6), lambda t: ('0x' || substr(md5('42:' || t || ':c'), 1, 15))::bigint % 2147483647) as c,
                   count(*) as n, greatest(2, ceil(sqrt(count(*))))::bigint as base
            from orders
        )
        select o_orderkey, list_reduce(range(0, 64), lambda v, k: case when v < n then v else MIXED(v) end, MIXED(o_orderkey)) as place
        from orders, keys
    """.replace("MIXED(v)", mixed("v")).replace("MIXED(o_orderkey)", mixed("o_orderkey")),
    "shuffle_permuted": """
        select doc_id, cast(quality as bigint) as quality, cast(toxic as bigint) as toxic from labels
    """,
    "fill_sentinel": f"""
        select doc_id, n_chars, cast(coalesce(quality, -999) as bigint) as quality,
               cast(coalesce(toxic, -999) as bigint) as toxic,
               case when quality is null then 'na' else 'q' || quality end as grade
        from ({LABELLED})
    """,
    "log_amount": "select o_orderkey, round(ln(o_totalprice + 1), 9) as logged from orders",
    "log_nonpositive": """
        select c_custkey, case when c_acctbal + 1 > 0 then round(ln(c_acctbal + 1), 9) end as logged from customer
    """,
    "family_project": f"select vec_id, {dimension_columns('cast(embedding[{place}] as double)')} from embeddings",
    "preview_topn": "select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 5",
    "label_split": f"""
        select doc_id, case toxic when 1 then 'positive' else 'negative' end as part
        from ({LABELLED}) where toxic is not null
    """,
    "class_counts": f"""
        select cast(toxic as bigint) as label, cast(count(*) as bigint) as n from ({LABELLED}) group by 1
    """,
    "class_balance_ratio": f"""
        select cast(sum(case when toxic = 1 then 1 else 0 end) as bigint) as positives,
               cast(sum(case when toxic = 0 then 1 else 0 end) as bigint) as negatives,
               cast(sum(case when toxic is null then 1 else 0 end) as bigint) as unlabelled,
               round(sum(case when toxic = 0 then 1.0 else 0.0 end)
                     / sum(case when toxic = 1 then 1 else 0 end), 9) as ratio
        from ({LABELLED})
    """,
    "oversample_replicate": """
        with r as (select cast(count(*) filter (toxic = 0) as double) / count(*) filter (toxic = 1) as ratio from labels)
        select doc_id, cast(toxic as bigint) as toxic
        from (select doc_id, toxic,
                     unnest(range(case when toxic = 0 then 1
                         else cast(floor(ratio) as bigint)
                              + case when cast('0x' || substr(md5(cast(doc_id as varchar)), 1, 8) as bigint) / 4294967296.0
                                          < ratio - floor(ratio) then 1 else 0 end end)) as nth
              from labels, r)
    """,
    "balance_weight": """
        select doc_id, round(case when toxic = 1 then
                   (select cast(count(*) filter (toxic = 0) as double) / count(*) filter (toxic = 1) from labels)
                   else 1.0 end, 9) as weight
        from labels where toxic is not null
    """,
    "shuffle_rows": """
        select doc_id, cast(quality as bigint) as quality, cast(toxic as bigint) as toxic from labels
    """,
    "category_counts": " union all ".join(
        f"""select '{c}' as "column", cast({c} as varchar) as label, cast(count(*) as bigint) as n
            from ({LABELLED}) group by 2"""
        for c in ("lang", "source", "quality")
    ),
    "category_index_map": index_map("documents", "lang", "source"),
    "category_index_map_many": index_map("orders", "o_custkey", "o_orderpriority", "o_orderstatus"),
    "category_index_apply": document_index(),
    "category_index_apply_shuffled": document_index(),
    "category_index_model": """
        select c_custkey, cast(coalesce(m.pos, (select count(distinct s_nationkey) from supplier)) as double) as nation_idx
        from customer
        left join (select s_nationkey, row_number() over (order by n desc, cast(s_nationkey as varchar)) - 1 as pos
                   from (select s_nationkey, count(*) as n from supplier group by 1)) m on c_nationkey = m.s_nationkey
    """,
    "onehot_long": " union all ".join(
        f"""select d.doc_id, '{c}' as "column", cast(m.slot as bigint) as slot, cast(m.labels + 1 as bigint) as width
            from documents d
            join (select label, row_number() over (order by n desc, label) - 1 as slot, count(*) over () as labels
                  from (select {c} as label, count(*) as n from documents group by 1)) m on d.{c} = m.label"""
        for c in ("lang", "source")
    ),
    # The bits of a positive double are in the order of the values.
    "median_fit_approximate": " union all ".join(
        f"""select '{c}' as "column", min(v) filter (lead = mid) as median, cast(count(*) as bigint) as rows,
                   cast(count(*) filter (lead < mid) as bigint) as below,
                   cast(count(*) filter (lead = mid) as bigint) as inside
            from (select v, lead, quantile_disc(lead, 0.5) over () as mid
                  from (select {c} as v, cast(cast({c} as double)::bit as bigint) >> 32 as lead from lineitem
                        where {c} is not null))"""
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
    "median_fit": medians("lineitem", "l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    "median_impute": f"""
        select doc_id, {dimension_columns('max(v) filter (i = {i})')} from ({IMPUTED_LONG}) group by doc_id
    """,
    "median_impute_expression": f"""
        select doc_id,
               cast(coalesce(quality, (select quantile_disc(quality, 0.5) from ({LABELLED}))) as double) as quality,
               cast(coalesce(toxic, (select quantile_disc(toxic, 0.5) from ({LABELLED}))) as double) as toxic
        from ({LABELLED})
    """,
    "minmax_fit": extremes("lineitem", "l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    "minmax_scale": """
        select o_orderkey, round((o_totalprice - low) / (high - low), 9) as scaled
        from orders, (select min(o_totalprice) as low, max(o_totalprice) as high from orders)
    """,
    "minmax_scale_vector": """
        select c_custkey, round((c_acctbal - low) / (high - low), 9) as scaled, cast(0.5 as double) as constant
        from customer, (select min(s_acctbal) as low, max(s_acctbal) as high from supplier)
    """,
    "assemble_block_error": f"""
        select vec_id, cast(count(*) as bigint) as width, round(sum(v), 6) as total,
               round(sum((i + 1) * v), 6) as weighted
        from ({EMBEDDING_LONG}) group by vec_id
    """,
    "assemble_block_skip": f"""
        select doc_id, cast(count(*) as bigint) as width, round(sum(v), 6) as total,
               round(sum((i + 1) * v), 6) as weighted
        from ({WIDE_LONG}) group by doc_id having count(v) = {DIMENSIONS}
    """,
    "covariance_matrix": f"""
        select 'E' || a.i as "row", 'E' || b.i as col, round(covar_samp(a.v, b.v), 9) as covariance
        from ({EMBEDDING_LONG}) a join ({EMBEDDING_LONG}) b on a.vec_id = b.vec_id
        group by a.i, b.i
    """,
    "pca_norms": f"select vec_id, round(sum(v * v), 6) as squared_norm from ({EMBEDDING_LONG}) group by vec_id",
    "pca_total_variance": f"""
        select round(sum(x), 6) as variance from (select var_samp(v) as x from ({EMBEDDING_LONG}) group by i)
    """,
    "features_fit_transform": feature_rows("v", 1),
    "features_compat": feature_rows("v", 0),
    "features_joined_index": feature_rows("v", 1),
    "features_sentinel": feature_rows(
        "case when doc_id in (select vec_id from embeddings) then v else -999 end", 1
    ),
    "features_all_components": f"""
        select d.doc_id,
               cast(1 + {DIMENSIONS} + (select count(distinct lang) + count(distinct source) + 2 from documents) as bigint)
                   as width,
               round(ln(d.n_chars + 1), 6) as amount, round(s.squares, 5) as block_squares
        from documents d
        join (select doc_id, sum(x * x) as squares
              from (select doc_id, (v - low) / (high - low) as x from ({IMPUTED_LONG})) group by doc_id) s
          on d.doc_id = s.doc_id
    """,
    "lr_fit_moments": """
        with l as (select case when l_linestatus = 'O' then 1.0 else 0.0 end as y, * from lineitem)
        select 'intercept' as feature, round(avg(y), 5) as moment from l
        """
    + "".join(
        f"union all select '{c}', round(avg(y * ({c} - low) / (high - low)), 5) "
        f"from l, (select min({c}) as low, max({c}) as high from l) "
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
    "lr_load_rates": f"""
        select line_id, round(r.score, 5) as open,
               case when r.score > 0.5 then 1.0::double else 0.0::double end as predictions
        from ({LINES}) l join (select kind, avg(label) as score from ({LINES}) group by kind) r on l.kind = r.kind
    """,
    "files_to_submission": """
        select o_orderkey, round(avg(case when o_orderstatus = 'F' then 1.0 else 0.0 end)
                                 over (partition by o_orderpriority), 5) as finished
        from orders
    """,
    "lr_fit_rates": f"select kind, round(avg(label), 5) as open from ({LINES}) group by kind",
    "lr_fit_folded": f"""
        select l.label, cast(count(*) as bigint) as rows, round(max(r.share), 5) as open
        from ({LINES}) l join (select kind, avg(label) as share from ({LINES}) group by kind) r on l.kind = r.kind
        group by l.kind, l.label
    """,
    "lr_fit_weighted_rates": f"""
        with l as ({LINES}),
             w as (select cast(count(*) filter (label = 0) as double) / count(*) filter (label = 1) as ratio from l)
        select kind, round(sum(label) * max(ratio) / (sum(label) * max(ratio) + sum(1 - label)), 5) as open
        from l, w group by kind
    """,
    "lr_fit_report": report(FITTED_LINES, 6),
    "lr_evaluate": report(FITTED_LINES, 6),
    "lr_score_fixed": """
        select o_orderkey, round(p, 9) as probability, case when p > 0.5 then 1.0::double else 0.0::double end as predictions
        from (select o_orderkey,
                     1 / (1 + exp(-(0.75::double + 2.5::double * (o_totalprice / 500000.0::double)
                                    - 0.25::double * length(o_orderpriority)))) as p
              from orders)
    """,
    "probability_unpack": """
        select o_orderkey, round(1 - o_totalprice / 500000.0::double, 9) as not_f,
               round(o_totalprice / 500000.0::double, 9) as f
        from orders
    """,
    "submission_roundtrip": f"""
        select line_id, round(r.score, 5) as open
        from ({LINES}) l join (select kind, avg(label) as score from ({LINES}) group by kind) r on l.kind = r.kind
    """,
    "confusion_matrix": f"""
        select cast(label as double) as label, cast(prediction as double) as prediction, cast(count(*) as bigint) as n
        from ({EVENTS}) group by 1, 2
    """,
    "label_list": "select distinct cast(toxic as double) as label from labels where toxic is not null",
    "accuracy": f"select round(avg(case when label = prediction then 1.0 else 0.0 end), 9) as accuracy from ({EVENTS})",
    "metrics_by_label": f"""
        select label, round(precision, 9) as precision, round(recall, 9) as recall,
               round(true_positive_rate, 9) as true_positive_rate, round(false_positive_rate, 9) as false_positive_rate
        from ({class_rates(EVENTS)})
    """,
    "metrics_report": report(EVENTS, 9),
    "roc_curve": f'select round(x, 9) as "FPR", round(y, 9) as "TPR" from ({curve_points(EVENTS)})',
    "roc_curve_bounded": f"""
        with p as (select distinct x, y from ({curve_points(EVENTS)})),
             c as (select least(cast(floor((x + y) / 2 * 51) as bigint), 50) as cell, x, y from p where x + y > 0),
             e as (select cell, min(x) as x0, min(y) as y0, max(x) as x1, max(y) as y1, count(*) as n from c group by cell),
             k as (select 0.0::double as x, 0.0::double as y, 0.0::double as b
                   union all select 1.0, 1.0, 0.0
                   union all select x0, y0, 0.0 from e
                   union all select x1, y1, case when n > 2 then (x1 - x0) * (y1 - y0) / 2 else 0.0 end from e)
        select round(x, 9) as "FPR", round(y, 9) as "TPR", round(max(b), 9) as bound from k group by x, y
    """,
    "auc_exact": f"select round(area, 9) as area from ({area(EVENTS)})",
    "auc_from_curve": f"select round(area, 9) as area from ({area(EVENTS)})",
    "csv_text_roundtrip": """
        select 'document' as kind, doc_id as id, cast(0 as bigint) as turn, text from documents
        union all select 'turn', conv_id, turn, text from conversations
    """,
    "left_join_null_keys": """
        select d.doc_id, d.labelled, cast(l.quality as bigint) as quality
        from (select doc_id, case when lang <> 'en' then doc_id end as labelled from documents) d
        left join labels l on d.labelled = l.doc_id
    """,
    "category_index_apply_sentinel": """
        select d.doc_id, case when l.toxic = 1 then cast(d.doc_id as varchar) else 'na' end as name,
               cast(case when l.toxic = 1 then m.pos else (select count(*) from labels) end as double) as name_idx
        from documents d left join labels l using (doc_id)
        left join (select doc_id, row_number() over (order by n desc, cast(doc_id as varchar)) - 1 as pos
                   from (select doc_id, count(*) as n from labels group by 1)) m using (doc_id)
    """,
    "holdout_split": """
        select doc_id, cast('0x' || substr(md5('hold-out:' || doc_id), 1, 8) as bigint) / 4294967296.0 < 0.2 as held_out
        from documents
    """,
    "train_curve": f"""select round(x, 9) as "FPR", round(y, 9) as "TPR" from ({curve_points(
        """select o.label, r.score
           from (select o_orderpriority, case when o_orderstatus = 'F' then 1 else 0 end as label from orders) o
           join (select o_orderpriority, avg(case when o_orderstatus = 'F' then 1.0 else 0.0 end) as score
                 from orders group by 1) r using (o_orderpriority)"""
    )})""",
    # Results that follow a draw or unfinished iterations: what holds for all of them.
    "pca_project": f"""
        select (select count(*) from embeddings) as rows, round(sum(x), 6) as total_variance,
               true as uncorrelated, true as falling, true as within_total
        from (select var_samp(v) as x from ({EMBEDDING_LONG}) group by i)
    """,
    "features_with_components": """
        select d.doc_id,
               cast(1 + 12 + (select count(distinct lang) + count(distinct source) + 2 from documents) as bigint) as width,
               round(ln(d.n_chars + 1), 6) as amount, cast(2 as double) as slots, false as bad_component,
               cast(l.toxic as bigint) as toxic
        from documents d left join labels l using (doc_id)
    """,
    "lr_fit_coefficients": """
        select cast(1 + 12 + count(distinct lang) + count(distinct source) + 2 as bigint) as weights,
               true as loss_below_zero_model, true as scores_follow
        from documents
    """,
    "lr_save_load_score": "select doc_id, true as same, true as logistic, true as threshold from documents",
    "train_and_score_files": "select doc_id, true as is_probability from documents",
}
