"""Where tests find their tables."""

SMALL = "/root/testdata/sf0.001"
