"""DataFrame-in, DataFrame-out operators and the table loads built on them."""
