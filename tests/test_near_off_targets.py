"""Off-targets with mismatches of all sites, against brute force."""

from collections import Counter

import numpy as np

from strandlake.plans import derived, registry

D = "/root/testdata/sf0.001"


def codes(seqs):
    return np.array([list(s.encode()) for s in seqs], np.uint8)


def test_all_sites_against_all_windows(spark):
    chroms = {r.chr: r.sequence for r in derived.chrom(spark, D).collect()}
    genes = {r.gene_id: r for r in derived.gene(spark, D).collect()}
    places = [(c, i + 1) for c, s in chroms.items() for i in range(len(s) - 13)]
    windows = codes([chroms[c][p - 1 : p + 13] for c, p in places])
    sites = registry._pre(spark, D, 14).select("gene_id", "site_id", "sequence").collect()
    found = registry.all_near_off_targets(spark, D).collect()
    got = {}
    for r in found:
        got.setdefault((r.gene_id, r.site_id), Counter())[r.chr, r.pos, r.hit_strand, r.mismatches] += 1
    assert len({g for g, _ in got}) > 40  # the query by id has 40 genes
    for s in sites[::197]:
        g, want = genes[s.gene_id], Counter()
        for strand, q in (("+", s.sequence), ("-", s.sequence[::-1].translate(str.maketrans("ACGT", "TGCA")))):
            far = (windows != codes([q])).sum(axis=1)
            for i in np.nonzero(far <= 2)[0]:
                c, p = places[i]
                if not (c == g.chr and p >= g.g_start and p + 13 <= g.g_end):
                    want[c, p, strand, int(far[i])] += 1
        assert got.get((s.gene_id, s.site_id), Counter()) == want
    totals = {(r.gene_id, r.site_id): r.hits for r in registry.all_off_target_summary(spark, D).collect()}
    assert totals == {k: sum(c.values()) for k, c in got.items()}
