"""Two overlapping listing sources made of the given tables.

``lineitem`` joined to ``part`` plays the large source A: each row is a
listing of vehicle (part, line number), so a VIN repeats. Two postings of
each ``part`` play source B. All rows of the tables are used. The texts carry
the faults of scraped data: missing-value tokens, punctuation only, case and
blanks, bad numbers, years like ``2015.0``, quotes, commas and line breaks.
The SQL runs on Spark and on other engines alike.
"""

RAW_A = """
select l_orderkey as pos,
 'a' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string)
   || '-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string) as listing_id,
 case when l_partkey % 17 = 0 then 'unknown' else p_brand end as franchise_make,
 case when l_partkey % 23 = 0 then '--' when l_partkey % 11 = 0 then upper(p_name) else p_name end as model_name,
 case when l_partkey % 41 = 0 then 'NA' else cast(1990 + p_size % 10 as string) end as year,
 case when l_partkey % 43 = 0 then 'call us' else cast(p_retailprice + l_linenumber as string) end as price,
 case when l_partkey % 19 = 0 then 'n/a'
      else cast((l_partkey * 7919 + l_linenumber * 1300) % 30000 as string) end as mileage,
 case when p_size % 3 = 0 then 'Diesel' when p_size % 3 = 1 then 'Gasoline' else '' end as fuel_type,
 case l_returnflag when 'R' then 'None' when 'A' then 'Automatic' else 'Manual' end as transmission,
 l_linestatus || 'WD' as wheel_system,
 p_type as body_type,
 'I' || cast(3 + p_size % 4 as string) as engine_cylinders,
 cast(1000 + p_size * 50 as string) || '.0' as engine_displacement,
 'City ' || cast(l_suppkey as string) as city,
 'Used ' || p_type || ', "' || p_name || '"' || chr(10) || 'lot ' || cast(l_suppkey as string) as description,
 case when l_partkey % 29 = 0 then ''
      else 'P' || lpad(cast(l_partkey * 10 + l_linenumber as string), 16, '0') end as vin,
 cast(l_quantity as string) as city_fuel_economy,
 cast(l_linenumber * 10 as string) as daysonmarket,
 cast(l_suppkey as string) as dealer_zip,
 case when l_linenumber = 3 then 'n/a' else cast(l_quantity + 5 as string) end as highway_fuel_economy,
 cast(l_extendedprice as string) as horsepower,
 cast(l_discount as string) as latitude,
 cast(0 - l_tax as string) as longitude,
 case when l_linenumber % 2 = 0 then 'True' else 'False' end as is_new,
 cast(null as string) as is_certified
from lineitem join part on l_partkey = p_partkey
"""

_POSTING = """
select p_partkey as pos,
 'b{n}' || cast(p_partkey as string) as id,
 case when p_partkey % 13 = 0 then 'unknown' when p_partkey % 4 = 0 then upper(p_brand) || '!'
      else p_brand end as manufacturer,
 case when p_partkey % 5 = 0 then '  ' || upper(p_name) || ' ' when p_partkey % 7 = 0 then p_name || ' s'
      else p_name end as model,
 case when p_partkey % 31 = 0 then 'NA' else cast(1990 + p_size % 10 as string) || '.0' end as year,
 case when p_partkey % 37 = 0 then '7d' else cast(p_retailprice + {line} as string) end as price,
 cast((p_partkey * 7919 + ({line}) * 1300 + {n} - 1) % 30000 as string) as odometer,
 case when p_size % 3 = 0 then 'diesel' when p_size % 3 = 1 then 'gas' else 'unknown' end as fuel,
 case when p_size % 2 = 0 then 'automatic' else 'manual' end as transmission,
 case when p_size % 5 = 0 then 'na' else 'fwd' end as drive,
 p_type as type,
 case when p_size % 4 = 0 then 'null' else cast(3 + p_size % 4 as string) || ' cylinders' end as cylinders,
 case when p_partkey % 3 = 0 then 'tx' else 'ca' end as state,
 '"' || p_name || '", posting {n}' as description,
 {vin} as VIN
from part
"""
_LINE_1 = "1 + p_size % 7"
_LINE_2 = "case when p_partkey % 3 = 0 then 1 + p_size % 7 else 1 + (p_size + 3) % 7 end"
RAW_B = (
    _POSTING.format(n=1, line=_LINE_1,
                    vin=f"lower('P-' || lpad(cast(p_partkey * 10 + {_LINE_1} as string), 16, '0'))")
    + "union all"
    + _POSTING.format(n=2, line=_LINE_2, vin=(
        "case when p_partkey % 3 = 1 then 'NA' else "
        f"'p ' || lpad(cast(p_partkey * 10 + {_LINE_2} as string), 16, '0') end"))
)
