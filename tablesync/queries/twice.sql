(SELECT o_orderkey, o_totalprice * 2 AS twice FROM orders_for_file_query {query_filter}) q
