"""The layers as plans, and the jobs that publish them."""
