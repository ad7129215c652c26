"""Jobs made of several steps: table layouts, tracked loads, catalogue and wide-table loads."""
