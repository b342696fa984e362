"""The same results in plain SQL over the given tables, for comparison."""

from __future__ import annotations

from grovemart.schema import CLEAN_COLUMNS, COLUMN_NAMES, LOCATION_COLUMNS

_DATE_AND_PLACE = """
    strftime(o_orderdate, '%d/%m/%Y') as data_base,
    strftime(o_orderdate, '%Y') as ano_data_base,
    r_name as regiao,
    n_name as nome_uf,
    'N' || lpad(cast(n_nationkey as varchar), 2, '0') as sigla_uf,
    cast(n_nationkey as varchar) || '-' || c_mktsegment as codigo_microrregiao,
    c_mktsegment as nome_microrregiao,
    c_mktsegment || ' - ' || n_name as microrregiao,
    cast(c_custkey as varchar) as codigo_municipio,
    c_name as municipio,
    c_name || ' - ' || n_name as municipio_geografico
"""

# Text to date and to int, as the code's rules say: whole text, ASCII blanks around numbers.
_DATE = """case when regexp_full_match(data_base, '[0-9]{2}/[0-9]{2}/[0-9]{4}')
    then cast(try_strptime(data_base, '%d/%m/%Y') as date) end"""
_BLANK = r"[\x00-\x20\x7F]*"
_INT = f"""case when regexp_full_match(area_ha, '{_BLANK}[+-]?[0-9]+([.][0-9]*)?{_BLANK}')
         then try_cast(regexp_extract(area_ha, '[+-]?[0-9]+') as int)
         when regexp_full_match(area_ha, '{_BLANK}[+-]?[.][0-9]*{_BLANK}') then 0 end"""

# renamed: raw rows under their clean names. clean: missing area filled. registry: typed.
_REGISTRY = f"""
keyed as (
    select l_orderkey, {_DATE_AND_PLACE},
        case when l_partkey % 29 <> 0 then p_type end as especie_florestal,
        case when l_orderkey % 17 = 0 then null
             when l_orderkey % 23 = 0 then '-'
             when l_orderkey % 19 = 0 then cast(cast(l_quantity as int) as varchar) || '.7'
             else cast(cast(l_quantity as int) as varchar) end as area_ha
    from lineitem
    join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey
    join part on l_partkey = p_partkey
),
renamed as (select * exclude (l_orderkey) from keyed),
clean as (select * replace (coalesce(area_ha, '0') as area_ha) from renamed),
registry as (
    select * replace ({_DATE} as data_base, {_INT} as area_ha) from clean
)
"""

# The registry with texts that look nearly like dates and numbers.
_EDGES = f"""
{_REGISTRY},
edge_raw as (
    select * exclude (l_orderkey) replace (
        case l_orderkey % 31 when 1 then '01/01/+99999' when 2 then '01/01/-0005' else data_base end as data_base,
        case l_orderkey % 31 when 3 then '.5' when 4 then coalesce(area_ha, '1') || chr(133)
             when 5 then coalesce(area_ha, '1') || chr(8232) else coalesce(area_ha, '0') end as area_ha)
    from keyed
),
edges as (select * replace ({_DATE} as data_base, {_INT} as area_ha) from edge_raw)
"""

_ORDERS = f"""
clean_orders as (
    select {_DATE_AND_PLACE},
        o_orderpriority as especie_florestal,
        cast(cast(floor(o_totalprice) as bigint) as varchar) as area_ha,
        make_date(year(o_orderdate), 12, 31) as snapshot_date
    from orders
    join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey
)
"""

_STAR = f"""
{_REGISTRY},
dim_localizacao as (select distinct {", ".join(LOCATION_COLUMNS)} from registry),
dim_especie as (select distinct especie_florestal from registry),
dim_tempo as (
    select data, strftime(data, '%Y') as ano, strftime(data, '%m') as mes,
        strftime(data, '%d') as dia, strftime(data, '%Y-%m') as ano_mes,
        year(data) || '-' || quarter(data) as trimestre
    from (
        select cast(unnest(generate_series(min(data_base), max(data_base), interval 1 day)) as date)
            as data
        from registry
    )
),
fat_area as (select data_base, codigo_municipio, especie_florestal, area_ha from registry)
"""

_DIRTY = """
dirty as (
    select
        case when l_orderkey % 101 = 0 then 'X' || cast(c_custkey as varchar)
             else cast(c_custkey as varchar) end as codigo_municipio,
        case when c_custkey % 50 = 0 and l_linenumber = 7 then c_name || ' (old)'
             else c_name end as municipio,
        cast(l_quantity as int) as area_ha,
        case when l_orderkey % 13 <> 0 then cast(o_orderdate as date) end as data_base,
        case when l_linenumber <> 6 then o_orderpriority end as especie_florestal
    from lineitem
    join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey
),
dirty_dim as (
    select distinct codigo_municipio, municipio from dirty where codigo_municipio not like 'X%'
)
"""

_AREA = "cast(sum(area_ha) as bigint) as area_ha"



def _level(facts: str, join: str, name: str | None) -> str:
    """Areas by one column, in the columns of all levels."""
    names = ["ano", "regiao", "sigla_uf", "codigo_municipio", "especie_florestal"]
    values = ", ".join(f"{n if n == name else 'cast(null as varchar)'} as {n}" for n in names)
    bits = ", ".join(f"cast({int(n != name)} as int) as g_{n}" for n in names)
    by = f" group by {name}" if name else ""
    return f"select {values}, {_AREA}, {bits} from {facts} {join}{by}"


def _levels(facts: str) -> str:
    """Every level by itself, as its card: unknown days and cities leave their own levels only."""
    day, city = "join dim_tempo on data_base = data", "join cities using (codigo_municipio)"
    joins = {"ano": day, "regiao": city, "sigla_uf": city, "codigo_municipio": city, "especie_florestal": "", None: ""}
    return " union all ".join(_level(facts, join, name) for name, join in joins.items())


_CITIES = "cities as (select distinct codigo_municipio, regiao, sigla_uf from dim_localizacao)"
_GROUPING_SETS = f"with {_STAR}, {_CITIES} {_levels('fat_area')}"

_KEPT = """
    select {name} as dataset, snapshot_date, count(*) as registros,
        min(cast(strptime(data_base, '%d/%m/%Y') as date)) as data_inicial,
        max(cast(strptime(data_base, '%d/%m/%Y') as date)) as data_final,
        cast(sum(cast(area_ha as int)) as bigint) as area_ha{more}
    from clean_orders {where} group by snapshot_date
"""
_ONE_ROW = ", cast(1 as bigint) as linhas"
_FIRST = "where snapshot_date = (select min(snapshot_date) from clean_orders)"
_LAST = "where snapshot_date = (select max(snapshot_date) from clean_orders)"

# The later delivery: rows of 1995 gone, areas of 1996 and city names of 1997 changed.
_RENAMED = "renamed as (select * exclude (l_orderkey) from keyed)"
_CHANGED = """renamed as (
    select * exclude (l_orderkey) replace (
        case when ano_data_base = '1996' then '1' else area_ha end as area_ha,
        case when ano_data_base = '1997' then municipio || ' (novo)' else municipio end as municipio)
    from keyed where not (ano_data_base = '1995' and regiao = 'ASIA')
)"""
_CHANGED_STAR = _STAR.replace(_RENAMED, _CHANGED)

_COUNTS = """
        select 'clean' as etapa, count(*) as registros from clean
        union all select 'typed', count(*) from registry
        union all select 'dim_localizacao', count(*) from dim_localizacao
        union all select 'dim_tempo', count(*) from dim_tempo
        union all select 'dim_especie', count(*) from dim_especie
        union all select 'fat_area', count(*) from fat_area
"""

_RAW_HEADERS = ", ".join(f'{name} as "{header}"' for header, name in COLUMN_NAMES.items())

ORACLE_SQL: dict[str, str] = {
    "raw_registry": f"with {_REGISTRY} select {_RAW_HEADERS} from renamed",
    "clean_registry": f"with {_REGISTRY} select * from clean",
    "typed_registry": f"with {_REGISTRY} select * from registry",
    "typed_edge_rows": f"with {_EDGES} select * from edges",
    "calendar_edge_rows": f"with {_STAR} select * from dim_tempo",
    "fill_type_mismatch": f"with {_REGISTRY} select * from renamed",
    "location_dim": f"with {_STAR} select * from dim_localizacao",
    "species_dim": f"with {_STAR} select * from dim_especie",
    "date_bounds": f"""
        with {_REGISTRY}
        select min(data_base) as data_inicial, max(data_base) as data_final from registry
    """,
    "calendar_dim": f"with {_STAR} select * from dim_tempo",
    "area_fact": f"with {_STAR} select * from fat_area",
    "area_total": f"with {_STAR} select {_AREA} from fat_area",
    "area_by_year": f"""
        with {_STAR}
        select ano, {_AREA} from fat_area join dim_tempo on data_base = data group by ano
    """,
    "area_by_state": f"""
        with {_STAR}
        select sigla_uf, nome_uf, {_AREA}
        from fat_area join dim_localizacao using (codigo_municipio) group by sigla_uf, nome_uf
    """,
    "area_by_region": f"""
        with {_STAR}
        select regiao, {_AREA}
        from fat_area join dim_localizacao using (codigo_municipio) group by regiao
    """,
    "area_by_species": f"""
        with {_STAR}
        select e.especie_florestal, {_AREA}
        from fat_area f join dim_especie e
            on f.especie_florestal is not distinct from e.especie_florestal
        group by e.especie_florestal
    """,
    "top_cities": f"""
        with {_STAR}
        select codigo_municipio, municipio, {_AREA}
        from fat_area join dim_localizacao using (codigo_municipio)
        group by codigo_municipio, municipio
        order by sum(area_ha) desc nulls last, codigo_municipio limit 10
    """,
    "area_grouping_sets": _GROUPING_SETS,
    "csv_raw_roundtrip": f"""
        with {_REGISTRY}
        select * replace (
            'São "' || microrregiao || '"; Açaí' as microrregiao,
            municipio_geografico || '; \\ÁÉ, ção' as municipio_geografico)
        from clean
    """,
    "csv_stage_roundtrip": f"with {_REGISTRY} select * from clean",
    "parquet_roundtrip": f"with {_REGISTRY} select * from registry",
    "table_replace": f"with {_REGISTRY} select * from registry",
    "sql_over_registry": f"""
        with {_REGISTRY}
        select sigla_uf, especie_florestal, min(data_base) as data_inicial,
            max(data_base) as data_final, count(*) as registros, {_AREA}
        from registry group by sigla_uf, especie_florestal
    """,
    "pending_files": f"""
        with {_ORDERS}, days as (select distinct snapshot_date from clean_orders)
        select 'landed' as momento, 'registry' as dataset, snapshot_date, 'downloaded' as state
        from days
        union all
        select 'delivered_again', 'registry', max(snapshot_date), 'downloaded' from days
    """,
    "history_by_snapshot": f"""
        with {_ORDERS}
        select snapshot_date, count(*) as registros,
            min(cast(strptime(data_base, '%d/%m/%Y') as date)) as data_inicial,
            max(cast(strptime(data_base, '%d/%m/%Y') as date)) as data_final,
            cast(sum(cast(area_ha as int)) as bigint) as area_ha
        from clean_orders group by snapshot_date
    """,
    "delivery_headers": f"""
        with {_ORDERS}, days as (select distinct snapshot_date from clean_orders)
        select 'registry' as dataset, snapshot_date,
            case when snapshot_date = (select max(snapshot_date) from days) then 2 else 1 end::bigint as cabecalhos
        from days
        union all select 'second', max(snapshot_date), 1 from days
    """,
    "open_files": f"""
        with {_ORDERS}, days as (select distinct snapshot_date from clean_orders)
        select 'todos' as vista, 'registry' as dataset, unnest([min(snapshot_date), max(snapshot_date)]) as snapshot_date,
            'downloaded' as state
        from days
        union all select 'janela', 'registry', max(snapshot_date), 'downloaded' from days
    """,
    "compacted_history": f"""
        with {_ORDERS}
        select * exclude (dataset) from ({_KEPT.format(name="''", more=_ONE_ROW, where="")})
    """,
    "contended_history": f"""
        with {_ORDERS}
        select * exclude (dataset) from ({_KEPT.format(name="''", more=_ONE_ROW, where="")})
    """,
    "swept_history": f"""
        with {_ORDERS}
        select * exclude (dataset) from ({_KEPT.format(name="''", more=", cast(1 as bigint) as pastas", where="")})
    """,
    "latest_snapshot": f"""
        with {_ORDERS}
        select * from clean_orders
        where snapshot_date = (select max(snapshot_date) from clean_orders)
    """,
    "stream_ingest": f"with {_ORDERS} select * from clean_orders",
    "delivered_star_cards": _GROUPING_SETS,
    "area_levels_dirty": f"""
        with {_STAR}, {_CITIES}, {_DIRTY},
        facts as (select * exclude (municipio) from dirty)
        {_levels('facts')}
    """,
    "stream_redelivery": f"""
        with {_ORDERS}
        {_KEPT.format(name="'registry'", more="", where="")}
        union all {_KEPT.format(name="'plain'", more="", where=_FIRST)}
    """,
    "redelivery_rejected": f"""
        with {_ORDERS}
        {_KEPT.format(
            name="'registry'", where="",
            more=", cast(snapshot_date = (select max(snapshot_date) from clean_orders) as bigint) as rejeitadas")}
        union all {_KEPT.format(name="'second'", more=", cast(0 as bigint) as rejeitadas", where=_LAST)}
    """,
    "ragged_profile": f"""
        with {_REGISTRY},
        lines as (
            select * replace (
                case when l_orderkey % 37 <> 1 then especie_florestal end as especie_florestal,
                case when l_orderkey % 37 = 1 then '0' else coalesce(area_ha, '0') end as area_ha)
            from keyed
        )
        select 'registros' as medida, count(*) as valor from lines
        union all select 'datas', count({_DATE}) from lines
        union all select 'areas', count({_INT}) from lines
        union all select 'especies', count(especie_florestal) from lines
        union all select 'irregulares', count(*) from lines where l_orderkey % 37 in (1, 2)
        union all select 'irregulares no registro', count(*) from lines where l_orderkey % 37 in (1, 2)
    """,
    "incremental_star_cards": f"with {_CHANGED_STAR}, {_CITIES} {_levels('fat_area')}",
    "incremental_registry": f"with {_CHANGED_STAR} select * from registry",
    "incremental_locations": f"with {_CHANGED_STAR} select * from dim_localizacao",
    "incremental_periods": f"""
        with {_REGISTRY}
        select strftime(date_trunc('month', data_base), '%Y-%m-%d') as periodo,
            case when bool_or((ano_data_base = '1995' and regiao = 'ASIA') or ano_data_base = '1997'
                              or (ano_data_base = '1996' and area_ha is distinct from 1))
                then 'second' else 'first' end as corrida,
            count(*) filter (where not (ano_data_base = '1995' and regiao = 'ASIA')) as registros
        from registry group by 1
    """,
    "extra_columns": f"""
        with {_REGISTRY}
        select 'f' || right(codigo_municipio, 1) as fonte, count(*) as registros,
            count(especie_florestal) as observacoes, {_AREA}
        from registry group by 1
    """,
    "stage_counts": f"with {_STAR} {_COUNTS}",
    "recorded_checks": f"""
        with {_STAR} {_COUNTS}
        union all select 'registros', count(*) from registry
        union all select 'datas', count(data_base) from registry
        union all select 'areas', count(area_ha) from registry
        union all select 'especies', count(especie_florestal) from registry
    """,
    "typed_null_profile": f"""
        with {_REGISTRY}
        select count(*) as registros, count(data_base) as datas, count(area_ha) as areas,
            count(especie_florestal) as especies
        from registry
    """,
    "preview": f"""
        with {_REGISTRY}
        select * from registry
        order by {", ".join(f"{name} nulls first" for name in CLEAN_COLUMNS)} limit 5
    """,
    "location_key_duplicates": f"""
        with {_DIRTY}
        select codigo_municipio, count(*) as linhas
        from dirty_dim group by codigo_municipio having count(*) > 1
    """,
    "fact_orphans": f"""
        with {_DIRTY}
        select codigo_municipio, count(*) as fatos, {_AREA}
        from dirty
        where not exists (
            select 1 from dirty_dim d where d.codigo_municipio = dirty.codigo_municipio)
        group by codigo_municipio
    """,
    "area_despite_duplicates": f"""
        with {_DIRTY},
        one as (
            select codigo_municipio, max(municipio) as municipio
            from dirty_dim group by codigo_municipio
        )
        select codigo_municipio, municipio, {_AREA}
        from (select codigo_municipio, area_ha from dirty) join one using (codigo_municipio)
        group by codigo_municipio, municipio
    """,
}
