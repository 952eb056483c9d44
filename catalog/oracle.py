"""The same results in plain SQL, written on joins, unnest and window functions.

Each result names the common table expressions it needs; they are put in front of it.
"""

from __future__ import annotations

import re

CTES = {
    # Derived inputs (see FIXTURES.md) ------------------------------------------------
    "contigs": """
        select * from (
          select 'chr' || doc_id as chrom,
                 translate(lower(regexp_replace(text, '[^A-Za-z]', '', 'g')),
                           'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') as seq
          from documents) where seq <> ''""",
    "sized": """
        select *, case when size < 109 then 1 else cast(ceil((size - 109) / 60) as bigint) + 1 end as n_wins
        from (select chrom, cast(substr(chrom, 4) as bigint) as doc_id, seq, length(seq) as size from contigs)""",
    "windows": """
        select doc_id, i, chrom, least(i * 60, greatest(0, size - 109)) as off, substr(seq, (least(i * 60, greatest(0, size - 109)) + 1)::int, 109) as win
        from (select *, unnest(range(n_wins)) as i from sized)""",
    "placed": """
        select sample, name, l_linenumber, qty, l.w0, coalesce(l.size < 109, false) as short, t.chrom, t.off,
               case when other then replace(win, 'CGA', 'CTA') else win end as hap, qual
        from (select concat('s', l_suppkey % 3) as sample,
                     concat('r', concat_ws('.', l_orderkey, l_partkey, l_suppkey, l_linenumber, cast(l_quantity as int))) as name,
                     l_linenumber, cast(l_quantity as int) as qty, z.doc_id, z.size,
                     cast((l_orderkey * 31 + l_linenumber * 7) % least(60, case when z.size < 109 then z.size else 60 end) + 1 as int) as w0,
                     (z.n_wins * ((h * h) // 1000000 * h // 1000000)) // 1000000 as i,
                     l_suppkey % 3 = 1 or (l_suppkey % 3 = 2 and l_linenumber % 2 = 0) as other,
                     repeat(substr('+5:?DIN', l_linenumber, 1), 25) || repeat('I', 25) as qual
              from (select *, ((l_orderkey * 31 + l_linenumber * 7 + l_suppkey * 13) % 1000000)::bigint as h from lineitem) y
              left join sized z on z.doc_id = y.l_partkey % (select count(*) from documents)) l
        left join windows t on t.doc_id = l.doc_id and t.i = l.i""",
    "aln": """
        select sample, name as qname,
               case when lost then 4 when l_linenumber % 2 = 0 then 16 else 0 end as flag,
               case when lost then '*' else chrom end as rname,
               case when lost then 0 else off + w0 end as pos,
               case when lost then 0 else qty + 10 end as mapq,
               case when lost then '*' when short then length(substr(hap, w0, 50)) || 'M' when kind = 1 then '20M3D30M' when kind = 2 then '25M2I23M'
                    when kind = 3 then '5S45M' when kind = 5 then '3H50M' when kind = 6 then '10M4N40M'
                    when kind = 7 then '20=1X29M' else '50M' end as cigar,
               '*' as rnext, 0 as pnext, 0 as tlen,
               coalesce(case when short then substr(hap, w0, 50) when kind = 1 then substr(hap, w0, 20) || substr(hap, w0 + 23, 30)
                             when kind = 2 then substr(hap, w0, 25) || 'GT' || substr(hap, w0 + 25, 23)
                             when kind = 3 then 'AAAAA' || substr(hap, w0, 45)
                             when kind = 6 then substr(hap, w0, 10) || substr(hap, w0 + 14, 40)
                             else substr(hap, w0, 50) end, repeat('ACGTA', 10)) as seq,
               substr(qual, 1, length(coalesce(case when short then substr(hap, w0, 50) end, repeat('A', 50)))) as qual
        from (select *, qty = 50 or chrom is null as lost, w0 % 8 as kind from placed)""",
    "pairs": """
        select sample, header, seq1, substr(qual, 1, length(seq1)) as qual1, seq2, reverse(substr(qual, 1, length(seq2))) as qual2
        from (select sample, name as header, qual, coalesce(substr(hap, w0, 50), repeat('ACGTA', 10)) as seq1,
                     case when l_linenumber = 5 then ''
                          else coalesce(translate(reverse(substr(hap, case when short then w0 else w0 + 10 end, 50)), 'ACGT', 'TGCA'),
                                        repeat('TACGT', 10)) end as seq2
              from placed)""",
    "pile": """
        select concat('chr', o_orderkey % 20) as chrom, o_orderkey + 1 as pos,
               case when o_orderkey % 97 = 0 then 'N' when o_orderkey % 89 = 0 then lower(r) else r end as ref,
               concat('s', k) as sample, cast(depth as bigint) as depth, bases,
               case when depth = 0 then '*' else repeat('I', cast(depth as int)) end as quals
        from (select *, substr('ACGT', cast(o_orderkey % 4 + 1 as int), 1) as r,
                     case kind when 0 then n2 + 11 when 1 then n1 + n2 when 2 then n1 + n2 when 3 then n1 + n2
                               when 4 then n1 + n2 + 3 when 5 then n1 + n2 + 1 when 6 then 0 else n1 + 2 end as depth,
                     case kind when 0 then '^].,$*.+2AG,-1tN>.+2AGC^+,R' || repeat('A', n2)
                               when 1 then repeat('A', n1) || repeat('a', n2)
                               when 2 then repeat('.', n1) || repeat('c', n2)
                               when 3 then repeat('.+2AG', n1) || repeat(',', n2)
                               when 4 then repeat(',-3ttg', n1) || repeat('.-1T', n2) || repeat('.', 3)
                               when 5 then repeat('.', n1) || 'g' || repeat('*', n2)
                               when 6 then '*' else '<+1A>' || repeat('>', n1) end as bases
              from (select *, (o_orderkey + k * 3 * (n1 % 2)) % 8 as kind
                    from (select o_orderkey, cast(floor(o_totalprice) as bigint) % 16 as n1, o_custkey % 7 as n2,
                                 unnest([0, 1, 2]) as k from orders)))""",
    "listed": """
        select concat('chr', k % 20) as chrom, pos from (
          select p_partkey as k, p_partkey + 1 as pos from part
          union all select s_suppkey, s_suppkey + 100000001 from supplier)""",
    # Genome axis ---------------------------------------------------------------------
    "dict": """
        select chrom, row_number() over w as chrom_ord, length(seq) as len,
               coalesce(sum(length(seq)) over (w rows between unbounded preceding and 1 preceding), 0)::bigint as off
        from contigs window w as (order by cast(regexp_extract(chrom, '\\d+') as bigint), chrom)""",
    "mapped": "select * from aln where rname <> '*' and (flag & 4) = 0",
    "cum": """
        select m.*, d.chrom_ord, cast(d.off + m.pos as bigint) as cum_pos
        from mapped m join dict d on d.chrom = m.rname""",
    "bounds": """
        select distinct cum_pos as bound
        from (select cum_pos, row_number() over (order by cum_pos) as i, count(*) over () as n from cum)
        where i % greatest(1, n // 16) = 0""",
    "segs": """
        select i as seg, lag(bound) over (order by i) - 300 as lo, bound as hi
        from (select row_number() over (order by bound) - 1 as i, bound from bounds
              union all select (select count(*) from bounds), null)""",
    # Text pileup ---------------------------------------------------------------------
    "tokens": r"""
        select chrom, pos, ref, sample, unnest(regexp_extract_all(bases, '\^.|[+-][0-9]+[A-Za-z]*|.')) as tok
        from pile where depth > 0""",
    "marks": """
        select *, cast(regexp_extract(tok, '[0-9]+') as int) as size, regexp_extract(tok, '[A-Za-z]*$') as letters
        from tokens where regexp_matches(tok, '^[+-][0-9]')""",
    "singles": """
        select chrom, pos, ref, sample, upper(tok) as base from tokens
        where length(tok) = 1 and tok not in ('^', '$')
        union all
        select chrom, pos, ref, sample, upper(unnest(string_split(substr(letters, size + 1), '')))
        from marks where length(letters) > size""",
    "letters": """
        select chrom, pos, sample, allele, count(*) as n
        from (select chrom, pos, sample,
                     case when base in ('.', ',') then upper(ref) when base = '*' then '-' else base end as allele
              from singles)
        where allele in ('A', 'C', 'G', 'T', 'N', '-')
        group by chrom, pos, sample, allele""",
    "tindels": """
        select chrom, pos, sample, indel, count(*) as n
        from (select chrom, pos, sample, tok[1] || upper(substr(letters, 1, size)) as indel from marks)
        group by chrom, pos, sample, indel""",
    "ranked": """
        select *, row_number() over (partition by chrom, pos, sample order by n desc, allele desc) as rk from letters""",
    "tsite": """
        select p.chrom, p.pos, p.ref, p.sample, upper(p.ref) as u,
               case when a.k is null then 0 else p.depth end as cov, coalesce(a.k, 0) as k,
               a.a1, a.n1, a.a2, coalesce(a.n2, 0) as n2, a.a_all,
               coalesce(n_a, 0) as n_a, coalesce(n_c, 0) as n_c, coalesce(n_g, 0) as n_g, coalesce(n_t, 0) as n_t,
               coalesce(n_n, 0) as n_n, coalesce(n_del, 0) as n_del,
               coalesce(i.ni, 0) as ni, coalesce(i.tot, 0) as tot, i.top, coalesce(i.nd, 0) as nd, i.longest
        from pile p
        left join (select chrom, pos, sample, count(*) as k,
                          max(allele) filter (rk = 1) as a1, max(n) filter (rk = 1) as n1,
                          max(allele) filter (rk = 2) as a2, max(n) filter (rk = 2) as n2,
                          string_agg(allele || ':' || n, ',' order by rk) as a_all,
                          max(n) filter (allele = 'A') as n_a, max(n) filter (allele = 'C') as n_c,
                          max(n) filter (allele = 'G') as n_g, max(n) filter (allele = 'T') as n_t,
                          max(n) filter (allele = 'N') as n_n, max(n) filter (allele = '-') as n_del
                   from ranked group by all) a using (chrom, pos, sample)
        left join (select chrom, pos, sample, count(*) as ni, sum(n)::bigint as tot,
                          arg_max(indel, (n, indel)) as top, count(*) filter (indel[1] = '-') as nd,
                          arg_max(substr(indel, 2), (length(indel), n, indel)) filter (indel[1] = '-') as longest
                   from tindels group by all) i using (chrom, pos, sample)""",
    # Derived per-sample values of either pileup; `site` below is the text route.
    "tcall": """
        select *, case when cov = 0 then '.' when n1 = n2 and a1 = u then a2 else a1 end as major,
               case when cov = 0 or k < 2 then '' when n1 = n2 and a1 = u then a1 else a2 end as minor,
               case when cov = 0 then 0.0::double else n1 / cov end as purity,
               case when cov = 0 then 0.0::double else
                 (case u when 'A' then n_a when 'C' then n_c when 'G' then n_g when 'T' then n_t when 'N' then n_n else 0 end) / cov end as ref_freq,
               case when cov = 0 then 0.0::double else (case when a1 <> u then n1 else n2 end) / cov end as alt_freq,
               case when cov = 0 then 0.0::double else tot / cov end as indel_purity,
               case when ni > 0 and nd * 2 > ni then longest else '' end as max_indel
        from tsite""",
    "tpred": """
        select *, cov > 0 and major not in ('N', '-') and not coalesce(a2 = '-', false) as clean,
               case when cov = 0 then '.' when cov >= 10 and purity <= 0.7::double then major || '/' || minor else major end as basecall
        from tcall""",
    "tflag": """
        select *, coalesce(clean and u <> 'N' and major <> u and cov >= 3 and purity >= 0.98::double, false) as snp,
               coalesce(clean and cov >= 10 and purity <= 0.7::double, false) as het,
               coalesce(cov > 0 and ni > 0 and cov >= 1 and indel_purity >= 0.5::double, false) as ind,
               coalesce(cov > 0 and a1 <> 'N' and cov >= 5 and ref_freq <= 0.5::double, false) as vari,
               u not in ('.', 'N') as known
        from tpred""",
    "tall": """
        select chrom, pos, sample, string_agg(allele, '/' order by rk) as basecall
        from ranked join tsite using (chrom, pos, sample)
        where rk = 1 or n / cov >= 0.1::double group by all""",
    "tflags": """
        select chrom, pos, ref, bool_or(known and snp) as snp, bool_or(known and het) as het,
               bool_or(known and ind) as ind, bool_or(known and vari) as vari
        from tflag group by all""",
    "ttype": """
        select chrom, pos,
               case when bool_or(ni > 0 and max_indel <> '') and bool_or(ni > 0 and max_indel = '') then 'IND'
                    when bool_or(ni > 0 and max_indel <> '') then 'DEL' else 'INS' end as type,
               arg_max(max_indel, length(max_indel) * 10 - cast(substr(sample, 2) as int)) as longest
        from tcall group by all having bool_or(ni > 0)""",
    "tshown": """
        select chrom, pos, sample,
               string_agg(ref || case when indel[1] = '+' then substr(indel, 2)
                                      else substr(longest_site, length(indel)) end, ',' order by n desc, indel desc) as alleles
        from (select i.*, s.ref, s.cov, s.top, t.longest as longest_site
              from tindels i join tsite s using (chrom, pos, sample) join ttype t using (chrom, pos))
        where indel = top or (cov > 0 and n / cov >= 0.1::double)
        group by all""",
    "tindelrow": """
        select c.chrom, c.pos, t.type, c.ref || t.longest as ref, c.sample,
               case when c.ni > 0 then s.alleles else c.ref || t.longest end as basecall, c.cov,
               case when c.ni > 0 then c.indel_purity else c.purity end as purity
        from tcall c join tflags f using (chrom, pos, ref) join ttype t using (chrom, pos)
        left join tshown s using (chrom, pos, sample) where f.ind""",
    "tbaserow": """
        select c.chrom, c.pos, case when f.snp then 'SNP' else 'HET' end as type, c.ref, c.sample, c.basecall, c.cov, c.purity
        from tpred c join tflags f using (chrom, pos, ref) where f.snp or f.het""",
    # CIGAR pileup --------------------------------------------------------------------
    "good": "select * from mapped where mapq >= 30 and (flag & 1796) = 0",
    "walk": """
        select *, coalesce(sum(case when op in ('M', 'D', 'N', '=', 'X') then len else 0 end) over w, 0)::int as r,
               coalesce(sum(case when op in ('M', 'I', 'S', '=', 'X') then len else 0 end) over w, 0)::int as q,
               lag(op) over (partition by sample, qname order by ix) as prev
        from (select sample, qname, rname as chrom, pos, seq, qual,
                     unnest(regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 1))::int as len,
                     unnest(regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 2)) as op,
                     unnest(range(length(regexp_extract_all(cigar, '[MIDNSHP=X]')))) as ix
              from good)
        window w as (partition by sample, qname order by ix rows between unbounded preceding and 1 preceding)""",
    "bases": """
        select sample, qname, chrom, pos + r + i as pos,
               case when op = 'D' then '*' else upper(substr(seq, (q + i + 1)::int, 1)) end as base,
               ascii(substr(qual, (case when op = 'D' then q + 1 else q + i + 1 end)::int, 1)) - 33 as bq
        from (select *, unnest(range(len)) as i from walk where op in ('M', '=', 'X', 'D'))""",
    "counts": """
        select chrom, pos, sample, count(*) as depth,
               count(*) filter (base = 'A') as n_a, count(*) filter (base = 'C') as n_c,
               count(*) filter (base = 'G') as n_g, count(*) filter (base = 'T') as n_t,
               count(*) filter (base = 'N') as n_n, count(*) filter (base = '*') as n_del,
               sum(case when base = 'A' then okc else 0 end)::bigint as ok_a, sum(case when base = 'C' then okc else 0 end)::bigint as ok_c,
               sum(case when base = 'G' then okc else 0 end)::bigint as ok_g, sum(case when base = 'T' then okc else 0 end)::bigint as ok_t,
               sum(case when base = 'A' then erc else 0 end)::bigint as er_a, sum(case when base = 'C' then erc else 0 end)::bigint as er_c,
               sum(case when base = 'G' then erc else 0 end)::bigint as er_g, sum(case when base = 'T' then erc else 0 end)::bigint as er_t
        from (select *, bq * 1000 as erc, round(-10000 * log10(1 - pow(10.0::double, -bq / 10.0::double)))::bigint as okc
              from bases where bq >= 13)
        group by all""",
    "sites": """
        select s.*, coalesce(nullif(substr(c.seq, s.pos::int, 1), ''), 'N') as ref
        from counts s left join contigs c using (chrom)""",
    "cindels": """
        select chrom, pos, sample, indel, count(*) as n from (
          select w.chrom, w.pos + w.r - 1 as pos, w.sample,
                 case when op = 'I' then '+' || upper(substr(w.seq, w.q + 1, len))
                      else '-' || upper(substr(c.seq, (w.pos + w.r)::int, len)) end as indel
          from walk w join contigs c using (chrom)
          where op in ('I', 'D') and prev in ('M', '=', 'X', 'D')
            and ascii(substr(w.qual, case when prev = 'D' then w.q + 1 else w.q end, 1)) - 33 >= 13)
        group by all""",
    "cranked": """
        select *, row_number() over (partition by chrom, pos, sample order by n desc, allele desc) as rk
        from (select chrom, pos, sample, unnest(['A', 'C', 'G', 'T', 'N', '-']) as allele,
                     unnest([n_a, n_c, n_g, n_t, n_n, n_del]) as n from counts) where n > 0""",
    "csite": """
        select s.chrom, s.pos, s.ref, s.sample, s.depth as cov, n_a, n_c, n_g, n_t, n_n, n_del, k, a1, a.n1, a2, coalesce(a.n2, 0) as n2,
               coalesce(i.ni, 0) as ni, coalesce(i.tot, 0) as tot, i.top, coalesce(i.nd, 0) as nd, i.longest
        from sites s
        join (select chrom, pos, sample, count(*) as k,
                     max(allele) filter (rk = 1) as a1, max(n) filter (rk = 1) as n1,
                     max(allele) filter (rk = 2) as a2, max(n) filter (rk = 2) as n2
              from cranked group by all) a using (chrom, pos, sample)
        left join (select chrom, pos, sample, count(*) as ni, sum(n)::bigint as tot,
                          arg_max(indel, (n, indel)) as top, count(*) filter (indel[1] = '-') as nd,
                          arg_max(substr(indel, 2), (length(indel), n, indel)) filter (indel[1] = '-') as longest
                   from cindels group by all) i using (chrom, pos, sample)""",
    "ccall": """
        select *, case when n1 = n2 and a1 = ref then a2 else a1 end as major,
               case when k < 2 then '' when n1 = n2 and a1 = ref then a1 else a2 end as minor,
               n1 / cov as purity, tot / cov as indel_purity,
               case when ni > 0 and nd * 2 > ni then longest else '' end as max_indel
        from csite""",
    "cflag": """
        select *, coalesce(clean and ref <> 'N' and major <> ref and cov >= 3 and purity >= 0.98::double, false) as snp,
               coalesce(clean and ref <> 'N' and cov >= 4 and purity <= 0.7::double, false) as het,
               coalesce(ref <> 'N' and ni > 0 and indel_purity >= 0.5::double, false) as ind
        from (select *, major not in ('N', '-') and not coalesce(a2 = '-', false) as clean from ccall)""",
    "cflags": """
        select chrom, pos, ref, bool_or(snp) as snp, bool_or(het) as het, bool_or(ind) as ind
        from cflag group by all""",
    "cfull": """
        select f.chrom, f.pos, f.ref, f.snp, f.het, f.ind, n.sample, coalesce(c.cov, 0) as cov,
               coalesce(c.purity, 0.0::double) as purity, coalesce(c.major, '.') as major, coalesce(c.minor, '') as minor,
               coalesce(c.ni, 0) as ni, coalesce(c.indel_purity, 0.0::double) as indel_purity, c.top,
               coalesce(c.max_indel, '') as max_indel
        from (select *, unnest(['s0', 's1', 's2']) as sample from cflags) n
        join cflags f using (chrom, pos, ref)
        left join ccall c on c.chrom = n.chrom and c.pos = n.pos and c.sample = n.sample""",
    "ctype": """
        select chrom, pos,
               case when bool_or(ni > 0 and max_indel <> '') and bool_or(ni > 0 and max_indel = '') then 'IND'
                    when bool_or(ni > 0 and max_indel <> '') then 'DEL' else 'INS' end as type,
               arg_max(max_indel, length(max_indel) * 10 - cast(substr(sample, 2) as int)) as longest
        from cfull where ind group by all""",
    "cshown": """
        select chrom, pos, sample,
               string_agg(ref || case when indel[1] = '+' then substr(indel, 2) else substr(longest, length(indel)) end,
                          ',' order by n desc, indel desc) as alleles
        from (select i.*, s.ref, s.cov, s.top, t.longest
              from cindels i join csite s using (chrom, pos, sample) join ctype t using (chrom, pos))
        where indel = top or n / cov >= 0.1::double group by all""",
    # Genotypes -----------------------------------------------------------------------
    "allc": """
        select chrom, pos, ref, sample, depth, b.base, b.n, b.ok, b.er
        from (select *, unnest([
                {'base': 'A', 'n': n_a, 'ok': ok_a, 'er': er_a}, {'base': 'C', 'n': n_c, 'ok': ok_c, 'er': er_c},
                {'base': 'G', 'n': n_g, 'ok': ok_g, 'er': er_g}, {'base': 'T', 'n': n_t, 'ok': ok_t, 'er': er_t}]) as b
              from sites)""",
    "alts": """
        select chrom, pos, sample, arg_max(base, (n, base)) as alt from allc
        where base <> ref and n > 0 and ref <> 'N' group by all""",
    "pls": """
        select chrom, pos, ref, alt, sample, depth, rr - m as pl_rr, ra - m as pl_ra, aa - m as pl_aa
        from (select *, least(rr, ra, aa) as m
              from (select chrom, pos, ref, alt, sample, depth,
                           floor((sum(case when base = ref then ok when base = alt then er else 0 end) + 500) / 1000)::bigint as rr,
                           floor((sum(case when base in (ref, alt) then n else 0 end) * 3010 + 500) / 1000)::bigint as ra,
                           floor((sum(case when base = ref then er when base = alt then ok else 0 end) + 500) / 1000)::bigint as aa
                    from allc join alts using (chrom, pos, sample) group by all))""",
    "gts": """
        select *, case when pl_rr = 0 and pl_ra = 0 and pl_aa = 0 then './.' when pl_rr = 0 then '0/0'
                       when pl_ra = 0 then '0/1' else '1/1' end as gt from pls""",
    "jalt": """
        select chrom, pos, ref, alt, bool_or(gt = '1/1') as hom from gts where gt in ('0/1', '1/1') group by all""",
    "jpl": """
        select chrom, pos, ref, alt, sample, depth, rr - m as pl_rr, ra - m as pl_ra, aa - m as pl_aa
        from (select *, least(rr, ra, aa) as m
              from (select chrom, pos, ref, alt, sample, depth,
                           floor((sum(case when base = ref then ok when base = alt then er else 0 end) + 500) / 1000)::bigint as rr,
                           floor((sum(case when base in (ref, alt) then n else 0 end) * 3010 + 500) / 1000)::bigint as ra,
                           floor((sum(case when base = ref then er when base = alt then ok else 0 end) + 500) / 1000)::bigint as aa
                    from allc join jalt using (chrom, pos, ref) group by all))""",
    "jall": """
        select s.hom, s.chrom, s.pos, s.ref, s.alt, s.sample, coalesce(p.pl_rr, 0) as pl_rr, coalesce(p.pl_ra, 0) as pl_ra,
               coalesce(p.pl_aa, 0) as pl_aa, coalesce(p.depth, 0) as cov,
               case when coalesce(p.pl_rr = 0 and p.pl_ra = 0 and p.pl_aa = 0, true) then './.' when p.pl_rr = 0 then '0/0'
                    when p.pl_ra = 0 then '0/1' else '1/1' end as gt
        from (select *, unnest(['s0', 's1', 's2']) as sample from jalt) s
        left join jpl p using (chrom, pos, ref, alt, sample)""",
    "mallele": """
        select chrom, pos, ref, list_prepend(ref, list(alt order by alt)) as alleles from jalt group by chrom, pos, ref""",
    "mpair": """
        select chrom, pos, ref, alleles, sample, depth, i, j,
               floor((sum(case when i = j and base = alleles[i + 1] then ok
                               when base = alleles[i + 1] or base = alleles[j + 1] then n * 3010 else er end) + 500) / 1000)::bigint as c
        from (select *, unnest(range(0, j + 1)) as i
              from (select *, unnest(range(0, len(alleles))) as j
                    from allc join mallele using (chrom, pos, ref) where list_contains(alleles, base)))
        group by all""",
    "mcall": """
        select chrom, pos, ref, alleles, sample, depth, string_agg((c - m)::varchar, ',' order by j, i) as pl,
               case when max(c - m) = 0 then './.' else arg_min(concat(i, '/', j), (c, (i > 0)::int + (j > 0)::int, j, i)) end as gt
        from (select *, min(c) over (partition by chrom, pos, sample) as m from mpair) group by chrom, pos, ref, alleles, sample, depth""",
    "mall": """
        select s.chrom, s.pos, s.ref, array_to_string(alleles[2:], ',') as alt, s.sample, coalesce(gt, './.') as gt,
               coalesce(pl, array_to_string(list_transform(range(0, len(alleles) * (len(alleles) + 1) // 2), lambda x: '0'), ',')) as pl,
               coalesce(depth, 0) as cov
        from (select *, unnest(['s0', 's1', 's2']) as sample from mallele) s
        left join (select chrom, pos, sample, depth, pl, gt from mcall) using (chrom, pos, sample)""",
    "vcf": """
        select chrom as "CHROM", pos as "POS", '.' as "ID", ref as "REF", alt as "ALT", '.' as "QUAL", '.' as "FILTER",
               'DP=' || sum(cov) as "INFO", 'GT:PL:DP' as "FORMAT",
               max(cell) filter (sample = 's0') as s0, max(cell) filter (sample = 's1') as s1, max(cell) filter (sample = 's2') as s2
        from (select chrom, pos, ref, alt, sample, cov, gt || ':' || pl_rr || ',' || pl_ra || ',' || pl_aa || ':' || cov as cell from jall)
        group by all""",
    # Calls per overlapping segment ---------------------------------------------------
    "copies": "select c.*, s.seg from cum c join segs s on (s.lo is null or c.cum_pos > s.lo) and (s.hi is null or c.cum_pos <= s.hi)",
    "scounts": """
        select seg, chrom, pos, sample, count(*) as cov,
               count(*) filter (base = 'A') as n_a, count(*) filter (base = 'C') as n_c, count(*) filter (base = 'G') as n_g,
               count(*) filter (base = 'T') as n_t, count(*) filter (base = 'N') as n_n, count(*) filter (base = '*') as n_del
        from bases b join (select sample, qname, seg from copies) c using (sample, qname) where bq >= 13 group by all""",
    "srow": """
        select s.seg, s.chrom, s.pos, coalesce(nullif(substr(c.seq, s.pos::int, 1), ''), 'N') as ref, s.sample, s.cov, t.*
        from scounts s left join contigs c using (chrom)
        join (select seg as seg_, chrom as chrom_, pos as pos_, sample as sample_, count(*) as k, max(allele) filter (rk = 1) as a1, max(n) filter (rk = 1) as n1,
                     max(allele) filter (rk = 2) as a2, max(n) filter (rk = 2) as n2
              from (select *, row_number() over (partition by seg, chrom, pos, sample order by n desc, allele desc) as rk
                    from (select seg, chrom, pos, sample, unnest(['A', 'C', 'G', 'T', 'N', '-']) as allele,
                                 unnest([n_a, n_c, n_g, n_t, n_n, n_del]) as n from scounts) where n > 0)
              group by all) t
          on t.seg_ = s.seg and t.chrom_ = s.chrom and t.pos_ = s.pos and t.sample_ = s.sample""",
    "scall": """
        select seg, chrom, pos, ref, sample, cov, n1 / cov as purity,
               case when n1 = n2 and a1 = ref then a2 else a1 end as major, coalesce(case when n1 = n2 and a1 = ref then a1 else a2 end, '') as minor, a2
        from srow""",
    "ssnp": """
        select distinct seg, chrom, pos, ref from scall
        where ref <> 'N' and major not in ('N', '-') and coalesce(a2, '') <> '-' and major <> ref and cov >= 3 and purity >= 0.98::double""",
    "sfull": """
        select n.seg, n.chrom, n.pos, n.ref, n.sample, coalesce(c.cov, 0) as cov, coalesce(c.purity, 0.0::double) as purity,
               case when c.cov is null then '.' when c.cov >= 10 and c.purity <= 0.7::double then c.major || '/' || c.minor else c.major end as basecall
        from (select *, unnest(['s0', 's1', 's2']) as sample from ssnp) n
        left join scall c using (seg, chrom, pos, ref, sample)""",
    # Seeds ---------------------------------------------------------------------------
    "refk": """
        select substr(seq, i::int, 20) as kmer, chrom, i as pos, len
        from (select chrom, seq, length(seq) as len, unnest(range(1, greatest(length(seq) - 18, 1))) as i from contigs)""",
    "kcount": """
        select kmer, count(*) as n, arg_min(chrom, (chrom_ord, pos)) as chrom, arg_min(pos, (chrom_ord, pos)) as pos
        from refk join (select chrom, chrom_ord from dict) using (chrom) group by all""",
    "mates": """
        select sample, header, case when seq2 = '' then 0 else 1 end as mate, seq1 as seq, qual1 as qual from pairs
        union all select sample, header, 2, seq2, qual2 from pairs where seq2 <> ''""",
    "seeds": """
        select read, strand, len, o, substr(s, (o + 1)::int, 20) as kmer
        from (select *, length(s) as len, unnest(list_distinct(list_concat(range(0, length(s) - 19, 10), [length(s) - 20]))) as o
              from (select distinct seq as read, '+' as strand, seq as s from mates where length(seq) >= 20
                    union all select distinct seq, '-', translate(reverse(seq), 'ACGT', 'TGCA') from mates where length(seq) >= 20))""",
    "votes": """
        select read, strand, chrom, k.pos - o as start, count(*) as votes
        from seeds s join refk k using (kmer)
        where k.pos - o >= 1 and k.pos - o + s.len - 1 <= k.len group by all""",
    "svotes": """
        select read, strand, chrom, pos as start, 1 as votes
        from (select distinct seq as read, '+' as strand, seq as kmer from mates where length(seq) between 1 and 19
              union all select distinct seq, '-', translate(reverse(seq), 'ACGT', 'TGCA') from mates where length(seq) between 1 and 19) s
        join (select chrom, i as pos, substr(seq, i::int, n::int) as kmer
              from (select chrom, seq, n, unnest(range(1, greatest(length(seq) - n + 2, 1))) as i
                    from contigs, (select distinct length(seq) as n from mates where length(seq) between 1 and 19))) k using (kmer)""",
    "bestp": """
        select read, strand, chrom, start, floor((votes - coalesce(next_votes, 0)) * 42 / votes)::int as mapq
        from (select v.*, row_number() over w as rk, lead(votes) over w as next_votes
              from (select * from votes union all select * from svotes) v join (select chrom, chrom_ord from dict) d using (chrom)
              window w as (partition by read order by votes desc, chrom_ord, start, strand))
        join contigs c using (chrom)
        where rk = 1 and 5 * len(list_filter(list_zip(
            string_split(case when strand = '-' then translate(reverse(read), 'ACGT', 'TGCA') else read end, ''),
            string_split(substr(c.seq, start::int, length(read)), '')), lambda p: p[1] <> p[2])) <= length(read)""",
    "matep": """
        select m.sample, m.header, m.mate, m.seq, m.qual, p.strand, p.chrom, p.start, p.mapq, length(m.seq) as size,
               o.strand as ostrand, o.chrom as ochrom, o.start as ostart, length(om.seq) as osize,
               greatest(p.start + length(m.seq), o.start + length(om.seq)) - least(p.start, o.start) as span,
               coalesce(p.chrom = o.chrom, false) as together
        from mates m left join bestp p on p.read = m.seq
        left join mates om on om.sample = m.sample and om.header = m.header and m.mate > 0 and om.mate = 3 - m.mate
        left join bestp o on o.read = om.seq""",
}

_T = "select chrom, pos, ref, sample, {} from {}"

RESULTS = {
    "read_pairs": "select sample, header, seq1, qual1, seq2, qual2 from pairs",
    "tag_samples": "select sample, header from pairs",
    "fastq_to_pairs": """
        select sample, header, seq1, qual1, seq2, qual2 from pairs
        union all select 'single', header, seq1, qual1, '', '' from pairs where seq2 = ''""",
    "fasta_contigs": """
        select chrom, length(seq)::bigint as len,
               (length(seq) - length(replace(seq, 'A', '')))::bigint as n_a, (length(seq) - length(replace(seq, 'C', '')))::bigint as n_c,
               (length(seq) - length(replace(seq, 'G', '')))::bigint as n_g, (length(seq) - length(replace(seq, 'T', '')))::bigint as n_t
        from contigs""",
    "ref_bases": """
        select distinct l.chrom, l.pos, coalesce(nullif(substr(c.seq, l.pos::int, 1), ''), 'N') as ref
        from listed l left join contigs c using (chrom)""",
    "position_list": "select distinct chrom, pos from listed",
    "manifest_missing": """
        select concat('s', s_suppkey) as sample, concat('sample=s', s_suppkey) as file from supplier
        where concat('s', s_suppkey) not in (select sample from pairs)""",
    "sam_rows": "select * from aln",
    "contigs": "select chrom, chrom_ord, len from dict",
    "split_sam_records": """
        select sample, concat_ws(chr(9), qname, flag, rname, pos) as value from aln
        union all select sample, concat_ws(chr(9), qname, flag, rname, pos) from aln""",
    "pileup_rows": "select * from pile",
    "vcf_rows_in": """
        select chrom, pos, sample, gt from jall""",
    "sorted_alignments": "select * from aln",
    "sorted_sam": "select sample, qname, flag, rname, pos, cigar from aln",
    "bin_index": """
        select sample, rname, bin, count(*) as n, min(pos) as first_pos, max(pos + span - 1) as last_end
        from (select a.*, (pos // 16384)::bigint as bin,
                     (select sum(x::int)::int from (select unnest(regexp_extract_all(cigar, '([0-9]+)[MDN=X]', 1)) as x)) as span
              from aln a where rname <> '*') group by all""",
    "genotype_matrix": """
        select chrom as "CHR", pos as "COORDINATE", type as "TYPE", ref as "REFBASE",
               max(basecall) filter (sample = 's0') as "s0_BASECALL", max(cov) filter (sample = 's0') as "s0_COV",
               max(printf('%.4f', purity)) filter (sample = 's0') as "s0_PURITY",
               max(basecall) filter (sample = 's1') as "s1_BASECALL", max(cov) filter (sample = 's1') as "s1_COV",
               max(printf('%.4f', purity)) filter (sample = 's1') as "s1_PURITY",
               max(basecall) filter (sample = 's2') as "s2_BASECALL", max(cov) filter (sample = 's2') as "s2_COV",
               max(printf('%.4f', purity)) filter (sample = 's2') as "s2_PURITY"
        from (select * from tbaserow union all select * from tindelrow) group by all""",
    "matrix_file": """
        select chrom as "CHR", pos::varchar as "COORDINATE", type as "TYPE", ref as "REFBASE",
               max(basecall) filter (sample = 's0') as "s0_BASECALL", max(cov::varchar) filter (sample = 's0') as "s0_COV",
               max(printf('%.4f', purity)) filter (sample = 's0') as "s0_PURITY",
               max(basecall) filter (sample = 's1') as "s1_BASECALL", max(cov::varchar) filter (sample = 's1') as "s1_COV",
               max(printf('%.4f', purity)) filter (sample = 's1') as "s1_PURITY",
               max(basecall) filter (sample = 's2') as "s2_BASECALL", max(cov::varchar) filter (sample = 's2') as "s2_COV",
               max(printf('%.4f', purity)) filter (sample = 's2') as "s2_PURITY"
        from tbaserow where type = 'SNP' group by all""",
    "vcf_rows": "select * from vcf",
    "tab5": "select sample, concat_ws(chr(9), header, seq1, qual1, seq2, qual2) as line from pairs",
    "fastq_out": """
        select sample, concat_ws(chr(10), '@' || header || case when seq2 = '' then '' else '_1' end, seq1, '+', qual1) as record from pairs
        union all select sample, concat_ws(chr(10), '@' || header || '_2', seq2, '+', qual2) from pairs where seq2 <> ''""",
    "aligned_only": "select sample, qname, rname, pos from mapped",
    "key_by_pos": "select sample, qname, rname, cast(regexp_extract(rname, '\\d+') as bigint) as chrom_num, pos from mapped",
    "min_mapq": "select sample, qname, mapq from aln where mapq >= 30",
    "region_filter": """
        select sample, qname, rname, pos, cigar from aln
        where rname = 'chr7' and pos <= 500
          and pos - 1 + (select sum(x::int)::int from (select unnest(regexp_extract_all(cigar, '([0-9]+)[MDN=X]', 1)) as x)) >= 100""",
    "at_positions": "select chrom, pos, ref, sample, cov from tsite where (chrom, pos) in (select (chrom, pos) from listed)",
    "fragment_pileup": """
        select chrom, pos, sample, count(*) as depth,
               count(*) filter (base = 'A') as n_a, count(*) filter (base = 'C') as n_c,
               count(*) filter (base = 'G') as n_g, count(*) filter (base = 'T') as n_t,
               count(*) filter (base = 'N') as n_n, count(*) filter (base = '*') as n_del
        from (select sample, header, chrom, pos, arg_max(base, (bq, mate <= 1)) as base
              from (select sample, header, mate, chrom, start + i - 1 as pos, upper(substr(s, i::int, 1)) as base, ascii(substr(q, i::int, 1)) - 33 as bq
                    from (select sample, header, mate, chrom, start, unnest(range(1, size + 1)) as i,
                                 case when strand = '-' then translate(reverse(seq), 'ACGT', 'TGCA') else seq end as s,
                                 case when strand = '-' then reverse(qual) else qual end as q
                          from matep where chrom is not null))
              where bq >= 13 group by all)
        group by all""",
    "pileup_opts": """
        with picked as (select * from mapped where mapq >= 15 and (flag & 20) = 0),
        steps as (
          select *, coalesce(sum(case when op in ('M', 'D', 'N', '=', 'X') then len else 0 end) over w, 0)::int as r,
                 coalesce(sum(case when op in ('M', 'I', 'S', '=', 'X') then len else 0 end) over w, 0)::int as q
          from (select sample, qname, rname as chrom, pos, seq, qual,
                       unnest(regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 1))::int as len,
                       unnest(regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 2)) as op,
                       unnest(range(length(regexp_extract_all(cigar, '[MIDNSHP=X]')))) as ix from picked)
          window w as (partition by sample, qname order by ix rows between unbounded preceding and 1 preceding)),
        each_base as (
          select sample, qname, chrom, (pos + r + i)::bigint as pos,
                 case when op = 'D' then '*' else substr(seq, (q + i + 1)::int, 1) end as base,
                 ascii(substr(qual, (case when op = 'D' then q + 1 else q + i + 1 end)::int, 1)) - 33 as bq
          from (select *, unnest(range(len)) as i from steps where op in ('M', '=', 'X', 'D')))
        select chrom, pos, sample, count(*) as depth, count(*) filter (base = 'A') as n_a, count(*) filter (base = 'C') as n_c,
               count(*) filter (base = 'G') as n_g, count(*) filter (base = 'T') as n_t, count(*) filter (base = 'N') as n_n,
               count(*) filter (base = '*') as n_del
        from each_base where bq >= 25 group by all""",
    "cum_offsets": 'select chrom, chrom_ord, off as "offset" from dict',
    "cum_pos": "select sample, qname, rname, pos, cum_pos from cum",
    "genome_sort": "select sample, qname, chrom_ord, pos from cum",
    "equal_bounds": "select bound from bounds",
    "sketch_bounds": "select unnest(range(1, 16)) as cut, n > 0 as near from (select count(*) as n from cum)",
    "segments": "select seg, lo, hi from segs",
    "assign_segment": """
        select sample, qname, cum_pos, (select count(*) from bounds where bound < cum_pos) as seg from cum""",
    "halo_segments": "select sample, qname, cum_pos, seg from copies",
    "kmers": "select kmer, n from kcount",
    "kmer_repeats": "select kmer, n, chrom, pos from kcount where n > 8",
    "diag_votes": "select * from votes",
    "mismatches": """
        select sample, header, count(*) filter (a <> b) as mismatches
        from (select m.sample, m.qname as header, unnest(string_split(m.seq, '')) as a,
                     unnest(string_split(substr(c.seq, m.pos, length(m.seq)), '')) as b
              from aln m join contigs c on c.chrom = m.rname where regexp_matches(m.cigar, '^([0-9]+H)?([0-9]+[M=X])+$')) group by all""",
    "seed_align": """
        select sample, header as qname,
               (case when chrom is null then 4 else 0 end + case when strand = '-' then 16 else 0 end
                + case when mate = 0 then 0 else
                    1 + 64 * mate
                    + case when together and strand <> ostrand and span <= 500 then 2 else 0 end
                    + case when ochrom is null then 8 else 0 end + case when ostrand = '-' then 32 else 0 end end)::int as flag,
               coalesce(chrom, '*') as rname, coalesce(start, 0)::int as pos, coalesce(mapq, 0)::int as mapq,
               case when chrom is null then '*' else size || 'M' end as cigar,
               case when together then '=' else coalesce(ochrom, '*') end as rnext, coalesce(ostart, 0)::int as pnext,
               (case when together then span * case when start < ostart or (start = ostart and mate = 1) then 1 else -1 end else 0 end)::int as tlen,
               case when strand = '-' then translate(reverse(seq), 'ACGT', 'TGCA') else seq end as seq,
               case when strand = '-' then reverse(qual) else qual end as qual
        from matep""",
    "pileup_counts": "select chrom, pos::bigint as pos, sample, depth, n_a, n_c, n_g, n_t, n_n, n_del from counts",
    "pileup_indels": "select chrom, pos::bigint as pos, sample, indel, n from cindels",
    "parse_pileup": """
        select p.chrom, p.pos, p.ref, p.sample, p.depth as cov, n_a, n_c, n_g, n_t, n_n, n_del
        from pile p join tsite using (chrom, pos, sample)""",
    "allele_counts": _T.format("coalesce(a_all, '') as alleles", "tsite"),
    "indel_counts": "select chrom, pos, sample, string_agg(indel || ':' || n, ',' order by n desc, indel desc) as indels from tindels group by all",
    "depth": _T.format("cov", "tsite"),
    "acgt_counts": _T.format("n_a, n_c, n_g, n_t", "tsite"),
    "major_minor": _T.format("major, minor", "tcall"),
    "purity": _T.format("purity", "tcall"),
    "ref_freq": _T.format("ref_freq", "tcall"),
    "alt_freq": _T.format("alt_freq", "tcall"),
    "site_flags": _T.format("cov > 0 as covered, k as num_alleles, ni as num_indels, ni > 0 as has_indel", "tcall"),
    "indel_purity": _T.format("indel_purity", "tcall"),
    "insertion": _T.format(
        "coalesce(top[1] = '+', false) as has_insertion, case when top[1] = '+' then substr(top, 2) else '' end as insertion", "tcall"
    ),
    "basecall": _T.format("basecall", "tpred"),
    "basecall_all": """
        select s.chrom, s.pos, s.ref, s.sample, coalesce(a.basecall, '.') as basecall
        from tsite s left join tall a using (chrom, pos, sample)""",
    "max_indel": _T.format("max_indel", "tcall"),
    "sample_view": """
        select chrom, pos, cov > 0 as covered, cov, basecall, purity, major, minor, coalesce(top[1] = '+', false) as has_insertion,
               case when top[1] = '+' then substr(top, 2) else '' end as insertion, indel_purity
        from tpred where sample = 's1'""",
    "sample_snp": "select chrom, pos, ref, sample from tflag where snp",
    "sample_het": "select chrom, pos, ref, sample from tflag where het",
    "sample_variant": "select chrom, pos, ref, sample from tflag where vari",
    "sample_indel": "select chrom, pos, ref, sample from tflag where ind",
    "site_calls": """
        select chrom, pos, ref, f.snp, f.het, f.ind as indel,
               bool_or(t.known and t.cov >= 3 and t.a1 <> 'N' and t.ref_freq <= 0.5::double) is true as variant
        from tflags f join tflag t using (chrom, pos, ref) group by all""",
    "call_variants": """
        select chrom, pos::bigint as pos, case when snp then 'SNP' else 'HET' end as type, ref, sample,
               case when cov = 0 then '.' when cov >= 4 and purity <= 0.7::double then major || '/' || minor else major end as basecall,
               cov, purity
        from cfull where snp or het
        union all
        select f.chrom, f.pos::bigint, t.type, f.ref || t.longest, f.sample,
               case when f.ni > 0 then s.alleles else f.ref || t.longest end, f.cov,
               case when f.ni > 0 then f.indel_purity else f.purity end
        from cfull f join ctype t using (chrom, pos) left join cshown s using (chrom, pos, sample) where f.ind""",
    "snp_rows": """
        select chrom, pos::bigint as pos, 'SNP' as type, ref, sample,
               case when cov = 0 then '.' when cov >= 10 and purity <= 0.7::double then major || '/' || minor else major end as basecall,
               cov, purity
        from cfull where snp""",
    "manifest_calls": """
        select chrom, pos::bigint as pos, 'SNP' as type, ref, sample,
               case when cov = 0 then '.' when cov >= 10 and purity <= 0.7::double then major || '/' || minor else major end as basecall,
               cov, purity
        from cfull where snp""",
    "het_rows": "select * from tbaserow where type = 'HET'",
    "indel_type": "select chrom, pos, type, longest as max_indel from ttype",
    "indel_rows": "select * from tindelrow",
    "bsa_rows": """
        select c.chrom, c.pos, 'BSA' as type, c.ref, c.sample, coalesce(a.basecall, '.') as basecall, c.cov, c.ref_freq,
               concat_ws(',', c.n_a, c.n_c, c.n_g, c.n_t) as acgt
        from tcall c join tflags f using (chrom, pos, ref) left join tall a using (chrom, pos, sample) where f.vari""",
    "site_samples": "select chrom, pos::bigint as pos, ref, sample, cov, purity, major from cfull",
    "snarp": """
        select l.chrom, l.pos, case when x.chrom is null then 'UNK' else 'SNP' end as type,
               coalesce(x.ref, nullif(substr(g.seq, l.pos::int, 1), ''), 'N') as ref, l.sample,
               coalesce(a.basecall, '.') as basecall, coalesce(c.cov, 0) as cov, coalesce(c.purity, 0.0::double) as purity
        from (select distinct chrom, pos, unnest(['s0', 's1', 's2']) as sample from listed) l
        left join (select distinct chrom, pos, ref from pile) x using (chrom, pos)
        left join contigs g using (chrom)
        left join tcall c using (chrom, pos, sample) left join tall a using (chrom, pos, sample)""",
    "genotype_positions": """
        select chrom as "CHR", pos as "COORDINATE", type as "TYPE", ref as "REFBASE",
               max(basecall) filter (sample = 's0') as "s0_BASECALL", max(cov) filter (sample = 's0') as "s0_COV",
               max(p4) filter (sample = 's0') as "s0_PURITY",
               max(basecall) filter (sample = 's1') as "s1_BASECALL", max(cov) filter (sample = 's1') as "s1_COV",
               max(p4) filter (sample = 's1') as "s1_PURITY",
               max(basecall) filter (sample = 's2') as "s2_BASECALL", max(cov) filter (sample = 's2') as "s2_COV",
               max(p4) filter (sample = 's2') as "s2_PURITY"
        from (select l.chrom, l.pos, case when x.chrom is null then 'UNK' else 'SNP' end as type,
                     coalesce(x.ref, nullif(substr(g.seq, l.pos::int, 1), ''), 'N') as ref, l.sample,
                     coalesce(a.basecall, '.') as basecall, coalesce(c.cov, 0) as cov,
                     case when x.chrom is null then '0.0' else printf('%.4f', coalesce(c.purity, 0.0::double)) end as p4
              from (select distinct chrom, pos, unnest(['s0', 's1', 's2']) as sample from listed) l
              left join (select distinct chrom, pos, ref from csite) x using (chrom, pos)
              left join contigs g using (chrom)
              left join ccall c using (chrom, pos, sample)
              left join (select r.chrom, r.pos, r.sample, string_agg(allele, '/' order by rk) as basecall
                         from cranked r join csite s using (chrom, pos, sample)
                         where rk = 1 or n / cov >= 0.1::double group by all) a using (chrom, pos, sample))
        group by all""",
    "genotype_likelihood": "select chrom, pos::bigint as pos, ref, alt, sample, pl_rr, pl_ra, pl_aa from gts",
    "genotypes": "select chrom, pos::bigint as pos, ref, alt, sample, gt, depth as cov from gts where gt in ('0/1', '1/1')",
    "union_positions": "select distinct chrom, pos::bigint as pos from gts where gt = '1/1'",
    "site_genotypes": "select chrom, pos::bigint as pos, ref, alt, sample, gt, pl, cov from mall",
    "joint_genotypes": """
        select chrom, pos::bigint as pos, ref, alt, sample, gt, pl_rr, pl_ra, pl_aa, cov from jall where hom""",
    "union_samples": "select sample, header from pairs",
    "merged_order": "select distinct chrom, pos, type, ref from tbaserow",
    "exact_dedupe": """
        select distinct chrom as "CHR", pos::bigint as "COORDINATE", 'SNP' as "TYPE", ref as "REFBASE", s0_b as "s0_BASECALL", s0_c as "s0_COV", s0_p as "s0_PURITY",
               s1_b as "s1_BASECALL", s1_c as "s1_COV", s1_p as "s1_PURITY", s2_b as "s2_BASECALL", s2_c as "s2_COV", s2_p as "s2_PURITY"
        from (select seg, chrom, pos, ref,
                     max(basecall) filter (sample = 's0') as s0_b, max(cov) filter (sample = 's0') as s0_c,
                     max(printf('%.4f', purity)) filter (sample = 's0') as s0_p,
                     max(basecall) filter (sample = 's1') as s1_b, max(cov) filter (sample = 's1') as s1_c,
                     max(printf('%.4f', purity)) filter (sample = 's1') as s1_p,
                     max(basecall) filter (sample = 's2') as s2_b, max(cov) filter (sample = 's2') as s2_c,
                     max(printf('%.4f', purity)) filter (sample = 's2') as s2_p
              from sfull group by all)""",
    "merge_calls": """
        select chrom, pos::bigint as pos, 'SNP' as type, ref, sample, basecall, cov, purity
        from (select *, row_number() over (partition by chrom, pos, sample order by total desc, shape desc) as rk
              from (select *, sum(cov) over (partition by seg, chrom, pos) as total,
                           list((sample, basecall, cov, purity) order by sample) over (partition by seg, chrom, pos
                             rows between unbounded preceding and unbounded following) as shape
                    from sfull))
        where rk = 1""",
    "merge_vcf": "select * from vcf",
}


def _needed(sql: str) -> list[str]:
    """Names of the expressions a statement uses, each after those it builds on."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in ordered and re.search(rf"\b(?:from|join|in \(select \S+ from)\s+{name}\b", text):
                visit(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    return ordered


def _compose(sql: str) -> str:
    parts = [f"{name} as materialized ({CTES[name].strip()})" for name in _needed(sql)]
    body = sql.strip()
    if body.startswith("with "):
        return "with " + ",\n".join([*parts, body[len("with ") :]])
    return "with " + ",\n".join(parts) + "\n" + body


ORACLES = {name: _compose(sql) for name, sql in RESULTS.items()}
