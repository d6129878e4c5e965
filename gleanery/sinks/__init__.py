"""Writers: the LSA model store and the sampled cluster export."""
