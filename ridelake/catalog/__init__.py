"""Every operator as a runnable query over the stored tables, with its SQL check."""
