from lodestack.cli import main

raise SystemExit(main())
