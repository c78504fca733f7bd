"""Differential check of DOM-1 on the driver's pages: every element's name,
end boundary, depth and parent against a stdlib html.parser stack walk.
Usage: python tools/dom_diff_check.py [0.01|0.1]"""
import os
import sys, time
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT); sys.path.insert(0, os.path.join(ROOT, 'tests'))
from cardforge.session import local_session
from cardforge.operators.dom import dom_nodes
from htmlwalk import walk
from pyspark.sql import functions as F, Window
spark = local_session()
sf = sys.argv[1] if len(sys.argv)>1 else '0.01'
pages = spark.read.parquet(f'/root/testdata/sf{sf}/pages.parquet')
t=time.time()
nodes = dom_nodes(pages)
st = nodes.filter("kind='start'")
w = Window.partitionBy('page_id').orderBy('pos')
# ordinal of each start; end boundary = number of starts before end_pos
starts = nodes.filter("kind='start'").select('page_id','pos','name','end_pos','depth','parent_pos')
starts = starts.withColumn('ord', F.row_number().over(w)-1)
ordmap = starts.select('page_id', F.col('pos').alias('parent_pos'), F.col('ord').alias('parent_ord'))
# end boundary: count of starts with pos < end_pos
allpos = starts.groupBy('page_id').agg(F.sort_array(F.collect_list('pos')).alias('ps'))
res = starts.join(ordmap, ['page_id','parent_pos'], 'left').join(allpos, 'page_id') \
   .withColumn('endb', F.size(F.filter('ps', lambda p: p <= F.col('end_pos')))) \
   .select('page_id','ord','name','endb','depth','parent_ord').collect()
print('spark rows', len(res), 'in', round(time.time()-t,1), 's')
got = {}
for r in res: got.setdefault(r.page_id, []).append(r)
bad = 0; total=0
for row in pages.select('page_id','html').collect():
    ref = walk(row.html)
    mine = sorted(got.get(row.page_id, []), key=lambda r: r.ord)
    total += len(ref)
    if len(ref) != len(mine):
        bad += 1; print('count', row.page_id, len(ref), len(mine)); continue
    for i,(a,b) in enumerate(zip(ref, mine)):
        exp = (a['name'], a['end'], a['depth'], a['parent'])
        g = (b.name, b.endb, b.depth, b.parent_ord)
        if exp != g:
            bad += 1; print('diff', row.page_id, i, exp, g); break
print('pages with diffs', bad, 'elements', total)
